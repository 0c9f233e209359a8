"""Operator 8: token counts with a digest cache.

Each text's normalised content is digested; the digests, with a digest of the
tokenizer's file and library version, are joined to a stored table of counts.
Only the distinct misses are encoded, and their counts are appended to the
cache for later runs.

Normalisation is a parameter and must not change a count; the default makes a
null an empty text and keeps everything else, which holds for any tokenizer.

Defined cases: null text: 0 bytes, the count of an empty text; null or repeated
ids: each row is counted for itself; empty tables: empty result; texts of any
length are encoded whole; only the named columns are read, so extra columns
cannot clash. Copies are encoded once, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from cartlens.llm.common import enter, keep_cache, scratch, ship

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"
#: Texts handed to the library at once: at most this many characters, or one text.
ENCODE_CHARS = 500_000


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tokenizer_version(data: bytes, kind: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    if kind == "model":
        import sentencepiece
        library = f"sentencepiece {sentencepiece.__version__}"
    else:
        import tokenizers
        library = f"tokenizers {tokenizers.__version__}"
    return hashlib.sha256(library.encode() + b"\0" + data).hexdigest()


_loaded: dict[str, Callable[[list[str]], list[int]]] = {}
keep_cache("token_counts", _loaded.clear)


def counter(data: bytes, kind: str, version: str) -> Callable[[list[str]], list[int]]:
    """The library's counting function, loaded once per worker."""
    if version not in _loaded:
        if kind == "model":
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_proto=data)
            _loaded[version] = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer
            tk = Tokenizer.from_str(data.decode())
            tk.no_truncation()
            tk.no_padding()
            _loaded[version] = lambda texts: [len(x.ids) for x in tk.encode_batch(texts, add_special_tokens=False)]
    return _loaded[version]


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > ENCODE_CHARS:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def read_cache(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 4096,
                 normalise: Callable[[Column], Column] = null_to_empty) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit of every row. ``tokenizer`` is the
    path of a ``.model`` or ``.json`` file; ``cache`` the folder of stored counts (a
    new one below the shared folder when none is named)."""
    spark = docs.sparkSession
    ship(spark)
    kind = Path(tokenizer).suffix.lstrip(".")
    data = Path(tokenizer).read_bytes()
    version = tokenizer_version(data, kind)
    cache = cache or scratch(spark, "token-cache")
    shipped = spark.sparkContext.broadcast(data)  # one vocabulary file: a few MB whatever the corpus

    rows = docs.select(F.col(id_col).alias("id"), null_to_empty(F.col(text_col)).alias("raw"),
                       normalise(F.col(text_col)).alias("content"))
    rows = rows.select("id", F.octet_length("raw").cast("long").alias("n_bytes"), "content",
                       F.sha2(F.col("content"), 256).alias("digest"))
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest", "n_tokens")
    misses = rows.select("digest", "content").dropDuplicates(["digest"]).join(known, "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("token_counts")
        count = counter(shipped.value, kind, version)
        for b in batches:
            counts: list[int] = []
            for group in _groups(b.column(1).to_pylist()):
                counts += count(group)
            yield pa.record_batch([pa.array([version] * len(counts), pa.string()), b.column(0).cast(pa.string()),
                                   pa.array(counts, pa.int64())], names=["tokenizer", "digest", "n_tokens"])

    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = (spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.first("n_tokens").alias("n_tokens")))
    # A hot text's rows meet its count by the binary digest: a join on a key of its own, which
    # adaptive execution may split, rather than on the partitioning of the aggregate.
    counts = counts.select(F.unhex("digest").alias("key"), "n_tokens")
    return (rows.select("id", "n_bytes", F.unhex("digest").alias("key")).join(counts, "key", "left")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
