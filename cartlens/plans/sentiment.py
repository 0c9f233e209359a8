"""Review sentiment model (the sentiment notebook).

clean -> stratified 80/20 split -> relational TF-IDF (vocabulary and idf from
the training documents only) -> class-weighted multinomial logistic
regression -> hold-out report and confusion matrix -> score every review.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions.text import clean_review_text, text_length
from cartlens.operators import features, models, repair, softmax
from cartlens.operators import sentiment as sn
from cartlens.plans.etl import clean_reviews, clean_reviews_labelled
from cartlens.schema import MIN_REVIEW_LENGTH, SEED, SENTIMENT_TEST_FRACTION
from cartlens.session import cut_lineage, stored


def labelled_docs(raw_labelled: DataFrame, test_fraction: float = SENTIMENT_TEST_FRACTION,
                  seed: int = SEED) -> DataFrame:
    """B5/B6 -> B7 -> B8 -> J1 -> J2: (id, text, sentiment_label, is_test), split within each class.
    The cleaned texts are materialised here: the split reads them twice."""
    lab = clean_reviews_labelled(raw_labelled).withColumn("text", clean_review_text("text"))
    lab = repair.keep_where(lab, "text", lambda t: text_length(t) > MIN_REVIEW_LENGTH)
    lab = stored(lab.select(F.col("labelled_review_uid").alias("id"), "text", "sentiment_label"), "texts")
    return features.exact_split_flag(lab, "id", "sentiment_label", test_fraction, seed)


@dataclass
class TextFeatures:
    vocab: DataFrame      # term, df, idf
    n_train: DataFrame    # one row: n


def doc_postings(docs: DataFrame) -> DataFrame:
    """The packed term counts of every document, computed once and shared by
    vocabulary fitting and weighting."""
    return stored(sn.postings(docs.withColumn("_train", ~F.col("is_test")), "id", "text", "_train"), "postings")


def fit_text_features(docs: DataFrame, posts: DataFrame | None = None) -> TextFeatures:
    posts = posts if posts is not None else doc_postings(docs)
    n_train = docs.where(~F.col("is_test")).agg(F.count(F.lit(1)).alias("n"))
    # The vocabulary is read by weighting and scoring.
    return TextFeatures(stored(sn.vocabulary(posts, n_train), "vocabulary"), n_train)


@dataclass
class SentimentResult:
    model: softmax.Softmax
    text: TextFeatures
    classes: list[str]
    docs: DataFrame       # doc, label, w of the training documents
    weights: DataFrame    # id, term, number, weight of the labelled documents
    test_predictions: DataFrame
    report: DataFrame
    confusion: DataFrame


def train_sentiment(raw_labelled: DataFrame) -> SentimentResult:
    """The classes are those of the labelled reviews; their names (one per class) reach the driver."""
    docs = stored(labelled_docs(raw_labelled), "docs")
    posts = doc_postings(docs)
    tf = fit_text_features(docs, posts)
    index = cut_lineage(sn.class_index(docs, "sentiment_label"))
    classes = [r["sentiment_label"] for r in index.orderBy("label").collect()]
    balance = sn.class_weights(docs.where(~F.col("is_test")), "sentiment_label")
    # One row per class each.
    train = (docs.where(~F.col("is_test")).join(F.broadcast(index), "sentiment_label").join(F.broadcast(balance), "sentiment_label")
             .select(F.col("id").alias("doc"), F.col("label").cast("int").alias("label"), F.col("weight").alias("w")))
    # The terms' numbers ride along: the fit joins no terms with weights.
    numbers = softmax.numbered_terms(tf.vocab.select("term", "idf"))
    weights = stored(sn.tfidf(posts, numbers, "id", ["number"]), "weights")
    train = cut_lineage(train)
    model = softmax.fit(weights.select(F.col("id").alias("doc"), "number", F.col("weight").alias("x")), train, len(classes),
                        numbers=numbers)
    test = docs.where(F.col("is_test")).select("id", "sentiment_label")
    pred = cut_lineage(_labelled(test, weights, model, classes))
    report = features.classification_report(pred, "sentiment_label", "sentiment_pred")
    conf = features.confusion_matrix(pred, "sentiment_label", "sentiment_pred", classes)
    return SentimentResult(model, tf, classes, train, weights, pred, report, conf)


def _labelled(docs: DataFrame, weights: DataFrame, model: softmax.Softmax, classes: list[str]) -> DataFrame:
    """``docs`` with ``sentiment_pred``: a join of their terms' weights with the coefficients and a sum per
    class; equal scores go to the first class."""
    scores = sn.linear_scores(weights, model.coefficients, "id", len(classes))
    bias = F.array(*[F.lit(b) for b in model.bias])
    total = F.when(F.col("scores").isNull(), bias).otherwise(F.zip_with("scores", bias, lambda a, b: a + b))
    best = F.array_position(total, F.array_max(total)).cast("int") - 1
    return (docs.join(scores, "id", "left").withColumn("sentiment_pred", F.get(F.array(*[F.lit(c) for c in classes]), best))
            .drop("scores"))


def score_reviews(raw_reviews: DataFrame, result: SentimentResult) -> DataFrame:
    """``sentiment_pred`` for every review."""
    rev = clean_reviews(raw_reviews).withColumn("text", clean_review_text("text"))
    # Read for the terms and for the output: clean the texts once.
    docs = cut_lineage(rev.select(F.col("review_uid").alias("id"), "user_uid", "text"))
    weights = sn.tfidf(sn.postings(docs, "id", "text"), result.text.vocab, "id")
    return _labelled(docs, weights, result.model, result.classes).withColumnRenamed("id", "review_uid")


def multinomial_gradient(result: SentimentResult) -> DataFrame:
    """Per class the largest absolute gradient of the penalised weighted log-loss over all
    terms, at the fitted model and over its training rows: zero at the optimum."""
    n, k = result.docs.count(), len(result.classes)
    weights = result.weights.select(F.col("id").alias("doc"), "term", F.col("weight").alias("x"))
    rest = softmax.residuals(weights, result.docs, result.model.coefficients, result.model.bias)
    sums = (weights.join(rest, "doc").groupBy("term")
            .agg(*[F.sum(F.col("x") * F.get("r", F.lit(c))).alias(f"_g{c}") for c in range(k)]))
    total = sums.join(result.model.coefficients, "term").agg(*[
        F.max(F.abs(F.col(f"_g{c}") / n + F.get("coef", F.lit(c)) / n)).alias(f"_m{c}") for c in range(k)])
    return total.select(F.inline(F.array(*[F.struct(F.lit(name).alias("sentiment_label"), F.col(f"_m{c}").alias("max_abs_gradient"))
                                           for c, name in enumerate(result.classes)])))
