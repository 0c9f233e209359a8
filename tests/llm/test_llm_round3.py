"""Best-fit packing, whitening and hard negatives against brute force, with nulls, empties, ties, repeats and clashing columns."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartlens.llm import hard_negatives, language_id, packing, queries, sharding, url_filter, whitening

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MEDIUM = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- packing

def brute_pieces(rows, capacity):
    tok = Tokenizer.from_file(WORD_BPE)
    out = Counter()
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for k, lo in enumerate(range(0, len(ids), capacity)):
            part = ids[lo:lo + capacity]
            out[i, k, lo, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    return out


def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fit:
            rooms[min(fit)[1]] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def check_packed(got, capacity):
    """Offsets have no gaps or overlaps and no sequence is over-full; returns the sequences."""
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled.get(r["sequence_id"], 0) == r["offset"]
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= capacity for n in filled.values())
    return len(filled)


ODD = [None, "", " \n\t", "Hello WORLD", "a\xa0b c\x1cd\x85e", "é ́x ̈́", "<|endoftext|>", "x<|startoftext|>y <|endoftext|> z",
       "it's they'll I'VE 'S", "ΣΑΣ ΟΔΟΣ. İstanbul", "日本語 テキスト", "🙂👩‍👩‍👧 ok", "1234567 3.14", "a" * 5000, "word " * 3000, "\0 \0a", "ﬁ Å Å",
       "ÀÉÎÕÜ ß×ß ÿÿ ÞþÐð Straße. ÇA! É÷é naïve?! a.b.c (x) \u00ad y"]


def test_packing(spark):
    r = random.Random(3)
    rows = list(enumerate(ODD + [" ".join(f"w{r.randrange(300)}" for _ in range(r.randrange(60))) for _ in range(150)]))
    rows += [(None, "no id"), (3, "Hello WORLD"), (3, "Hello WORLD")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, piece int, rank int").repartition(5)
    for capacity in (64, 4096):
        got = packing.pack(df, WORD_BPE, capacity).collect()
        want = brute_pieces(rows, capacity)
        assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got) == want
        assert check_packed(got, capacity) == brute_best_fit([k[3] for k, n in want.items() for _ in range(n)], capacity)
    assert packing.pack(df.limit(0), WORD_BPE).collect() == []


def test_packing_ranks_over_many_tasks(spark, monkeypatch):
    """Sums of counts go through groups of tasks."""
    monkeypatch.setattr(packing, "TASKS_PER_GROUP", 2)
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', int(id % 3))").alias("text")).repartition(9)
    assert check_packed(packing.pack(df, WORD_BPE, 16).collect(), 16) == -(-sum(1 + i % 3 for i in range(500)) // 16)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 64, 500])
    lengths = [min(capacity, max(1, int(r.lognormvariate(2, 1.2)))) for _ in range(r.choice([1, 30, 900]))]
    plan = packing.Plan(Counter(lengths), capacity)
    n = np.array(lengths)
    rank = np.array([Counter(lengths[:i])[x] for i, x in enumerate(lengths)])
    sequence, offset = plan.place(n, rank)
    got = [{"sequence_id": s, "offset": o, "length": x} for s, o, x in zip(sequence.tolist(), offset.tolist(), lengths, strict=True)]
    assert check_packed(got, capacity) == plan.n_sequences == brute_best_fit(lengths, capacity)
    assert len(plan.rank) <= 3 * capacity * (2 * capacity) ** 0.5


def test_plan_refuses_what_cannot_fit():
    with pytest.raises(ValueError):
        packing.Plan({11: 1}, 10)
    assert packing.Plan({}).n_sequences == 0


def test_packing_query(spark):
    got = queries.QUERIES["op11_best_fit_packing"](spark, MEDIUM).collect()
    rows = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got) == brute_pieces(rows, 4096)
    assert check_packed(got, 4096) == brute_best_fit([x["length"] for x in got], 4096)


# -------------------------------------------------------------- whitening

def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def check_whitened(got, rows, k=32):
    """``got`` against eigh of the covariance of rows (id, vector) of one length."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = n * x - s
    cov = np.array([[sum(p * q for p, q in zip(a, b, strict=True)) / n**3 for b in y.T] for a in y.T], dtype=float)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    want = (y / n).astype(float) @ u
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    dev = (y * y).sum(axis=1)
    line = np.zeros((n, len(e)))
    for i, (vec, _) in enumerate(rows):
        own = by[vec]
        assert sorted(own) == list(range(1, len(e) + 1))
        assert {r["deviation"] for r in own.values()} == {int(dev[i])} and {r["n"] for r in own.values()} == {n}
        assert all(abs(r["explained"] - e[c - 1] / np.trace(cov)) < 1e-9 and r["identity_error"] < 1e-6 for c, r in own.items())
        line[i] = [own[c]["whitened"] for c in sorted(own)]
    want /= np.sqrt(e)
    assert np.abs(line * np.sign((line * want).sum(axis=0)) - want).max() < 1e-6


def test_whitening(spark):
    r = random.Random(5)
    mix = [[r.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    rows = [(i, (np.array([r.gauss(0, 1) for _ in range(6)]) @ np.array(mix) + 7).tolist()) for i in range(200)]
    bad = [(900, None), (901, []), (902, [None] * 6), (903, [float("nan")] * 6), (904, [1.0] * 5 + [float("inf")])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + bad], "vec_id long, embedding array<double>, n int, component int").repartition(4)
    got = whitening.whiten(df).collect()
    assert len(got) == 200 * 6
    check_whitened(got, rows)
    assert len(whitening.whiten(df, components=2).collect()) == 400
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id > 899")).collect() == []


def test_whitening_without_variance_lengths_and_limits(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0]), (3, [5.0, 1.0, 2.0]), (4, [3.0, 1.0, 2.0]), (4, [3.0, 1.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    flat = [r for r in got if r["vec_id"] in (1, 2, None)]
    assert len(flat) == 6 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 3 for r in flat)
    three = [r for r in got if r["vec_id"] in (3, 4)]
    assert len(three) == 9
    for r in three:
        if r["component"] == 1:
            assert abs(abs(r["whitened"]) - (2 ** 0.5 if r["vec_id"] == 3 else 0.5 ** 0.5)) < 1e-9 and abs(r["explained"] - 1) < 1e-12
        else:
            assert r["whitened"] is None
    huge = [(i, [x, 1e300 * (-1) ** i]) for i, x in enumerate([0.0, 1.0, 5.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in got} == {2**63 - 1} and all(r["identity_error"] < 1e-6 for r in got)


def test_squares_are_exact():
    r = np.random.default_rng(0)
    for top in (50, 2**31, 2**60):
        z = r.integers(-top, top, (40, 5))
        want = [sum((int(a) + int(b) if i != j else int(a)) ** 2 for a, b in zip(z[:, i], z[:, j], strict=True))
                for i in range(5) for j in range(i, 5)]
        assert whitening.squares(z) == want
        assert whitening.column_sums(z) == [sum(map(int, c)) for c in z.T]
    batch = whitening._limbs(3, [0, -5, 2**100 + 7, -(2**70)])
    total = Counter()
    for _, at, limb, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        total[at] += value << 32 * limb
    assert [total[i] for i in range(4)] == [0, -5, 2**100 + 7, -(2**70)]


def test_whitening_query(spark):
    got = queries.QUERIES["op12_whitening"](spark, MEDIUM).collect()
    rows = [(x["vec_id"], x["embedding"]) for x in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    assert len(got) == 32 * len(rows)
    check_whitened(got, rows)


# --------------------------------------------------------- hard negatives

def brute_mine(rows, positives=5, negatives=3):
    whole = [(i, lab, tuple(int(np.floor(256 * x)) for x in v)) for i, lab, v in rows if i is not None and lab is not None and usable(v)]
    out = Counter()
    for a, lab, q in {r for r in whole if r[0] % 50 == 0}:
        scored = sorted(((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(q, v, strict=True)))), i, other)
                         for i, other, v in whole if i != a and len(v) == len(q)))
        for s, p, _ in [x for x in scored if x[2] == lab][:positives]:
            inside = [(t, i) for t, i, other in scored if other != lab and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out.update((a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(inside))
    return out


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = hard_negatives.hilbert_keys(grid, bits)
        assert len(set(keys)) == len(grid)
        walk = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_zone_bounds_hold():
    r = np.random.default_rng(1)
    x, a = r.integers(-500, 500, (64, 16)), r.integers(-500, 500, (9, 16))
    under, over = hard_negatives.bounds(x.min(axis=0)[None], x.max(axis=0)[None], a)
    scores = hard_negatives.products(x, a)
    assert (scores == x @ a.T).all() and (under[:, 0] <= scores.min(axis=0)).all() and (over[:, 0] >= scores.max(axis=0)).all()


def test_first_rows():
    r = np.random.default_rng(2)
    for top in (3, 2**62):
        scores, allowed = r.integers(-top, top, (40, 7)), r.random((40, 7)) < 0.3
        allowed[:, 0] = False
        for c, rows in enumerate(hard_negatives.first_rows(scores, allowed, 5)):
            own = sorted(np.flatnonzero(allowed[:, c]).tolist(), key=lambda i: (-int(scores[i, c]), i))[:5]
            assert rows.tolist() == own


@pytest.mark.parametrize("block", [4, 512])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "CHUNK", 64)
    r = random.Random(6)
    rows = [(i, r.randrange(4), [abs(r.gauss(1, 0.7)) if r.random() < 0.8 else r.gauss(0, 1) for _ in range(5)]) for i in range(400)]
    rows += [(500 + i, i % 3, rows[0][2]) for i in range(9)] + [rows[50], rows[50], rows[7]]          # ties, repeated rows
    rows += [(100, 1, [0.5] * 5), (100, 2, [0.5] * 5), (100, 1, [0.5, 1.0])]                          # one id, several rows
    rows += [(600, 1, None), (601, 1, []), (602, 1, [None] * 5), (603, 1, [float("nan")] * 5), (604, 1, [float("inf")] * 5),
             (None, 1, rows[1][2]), (650, None, rows[2][2]), (700, 9, [1.0, 2.0]), (701, 9, [1.0, 1.0]), (702, 8, [0.5, 1.3]),
             (750, 7, [1e7] * 5), (751, 7, [2e7] * 5), (752, 6, [1.5e7] * 5), (800, 5, [-1.0] * 5), (801, 5, [1.0] * 5), (802, 4, [0.6] * 5)]
    df = spark.createDataFrame([(i, lab, v, 1, 2) for i, lab, v in rows],
                               "vec_id long, label int, embedding array<double>, code int, chunk int").repartition(3)
    got = hard_negatives.mine(df, F.col("id") % 50 == 0).collect()
    assert Counter(tuple(x) for x in got) == brute_mine(rows)
    assert hard_negatives.mine(df.limit(0), F.col("id") % 50 == 0).collect() == []
    assert hard_negatives.mine(df.where("label = 1"), F.col("id") % 50 == 0).collect() == []


def test_zone_maps_skip_blocks(spark):
    """On clustered vectors most pairs of anchor and block are never chosen."""
    r = random.Random(8)
    rows = [(i, i % 40, [(10.0 if d == i % 40 else 0.0) + r.random() / 50 for d in range(40)]) for i in range(4000)]
    whole = spark.createDataFrame(rows, "id long, label long, v array<double>").select(
        "id", "label", F.transform("v", lambda x: F.floor(256 * x).cast("long")).alias("v"))
    blocks = hard_negatives.hilbert_blocks(whole)
    zones = hard_negatives.zone_maps(blocks)
    anchors = hard_negatives.first_scores(blocks, F.col("id") % 50 == 0, 5)
    chosen = hard_negatives.chosen_blocks(
        zones.withColumn("chunk", F.col("part")).drop("part"), anchors, zones.count(),
        lambda part, l0, l1, under, over: over >= part.column(part.schema.get_field_index("least")).to_numpy()[:, None])
    read = chosen.agg(F.sum(F.size("codes"))).first()[0]
    assert read < 0.5 * anchors.count() * zones.count()


# ------------------------------------------- language ID, names that clash

def brute_languages(spark, docs):
    """Predictions from scratch: plain counts and a word-by-word Viterbi, over the same sample rule."""
    import math
    import re
    from cartlens.llm import common, language_id as li
    picked, held = {}, {r["doc_id"]: r["h"] for r in docs.select("doc_id", li.hold_out().alias("h")).collect()}
    hashes = {r["doc_id"]: r["x"] for r in docs.select("doc_id", F.xxhash64("doc_id").alias("x")).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    for r in rows:
        if r["lang"] and r["text"] is not None and not held[r["doc_id"]]:
            picked.setdefault(r["lang"], []).append((hashes[r["doc_id"]], r["doc_id"], r["text"]))
    langs = sorted(picked)

    def words(text):
        return [w.lower() if w.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in re.findall(rb"[A-Za-z\x80-\xff]+", text.encode())]

    def slots(word):
        padded = b" " + word + b" "
        keys = [padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2] for i in range(len(word))]
        return (common.mix(np.array(keys, np.uint64) + np.uint64(1)) % np.uint64(li.TRIGRAM_SLOTS)).tolist()

    count, tri = {x: Counter() for x in langs}, {x: Counter() for x in langs}
    for x in langs:
        for _, _, text in sorted(picked[x])[:li.PER_LANG]:
            for w in words(text):
                count[x][w] += 1
                tri[x].update(slots(w))
    assert all(len(c) <= li.TOP_WORDS for c in count.values())
    known = set().union(*count.values())
    out = {}
    for r in rows:
        text = r["text"] or ""
        found = words(text)
        if not any(c.isalpha() for c in text):
            out[r["doc_id"]] = "und", 0.0
            continue
        best, back, first = None, [], None
        for w in found:
            s = []
            for x in langs:
                one = sum(math.log((tri[x][k] + 0.5) / (sum(tri[x].values()) + 0.5 * li.TRIGRAM_SLOTS)) for k in slots(w))
                if w in known:
                    one += math.log((count[x][w] + 0.5) / (sum(count[x].values()) + 0.5 * (len(known) + 1)))
                s.append(one)
            s = [max(v - max(s), -li.WORST) for v in s]
            if best is None:
                best = s
            else:
                top = max(range(len(langs)), key=lambda k: (best[k], -k))
                back.append([k if best[k] >= best[top] - li.SWITCH else top for k in range(len(langs))])
                best = [max(best[k], best[top] - li.SWITCH) + s[k] for k in range(len(langs))]
        path = [max(range(len(langs)), key=lambda k: (best[k], -k))]
        for b in reversed(back):
            path.append(b[path[-1]])
        share = Counter()
        for w, k in zip(found, reversed(path), strict=True):
            share[k] += len(w)
        k = max(share, key=lambda k: (share[k], -k))
        out[r["doc_id"]] = langs[k], share[k] / sum(share.values())
    return out


def test_language_predictions_against_brute_force(spark):
    """Whole predictions on Latin texts: the sample, word scores, shares and ties, not the Viterbi pass alone."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 2500 or text is null").where(
        ~F.col("text").rlike("[\\u0250-\\uffff]"))
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()][:120]
    docs = docs.where(F.col("doc_id").isin(ids))
    got = language_id.identify(docs, language_id.fit(docs)).collect()
    want = brute_languages(spark, docs)
    assert len(got) == len(want) > 50
    assert all(r["lang_pred"] == want[r["c0"]][0] and abs(r["score"] - want[r["c0"]][1]) < 1e-9 for r in got)


def test_signs_are_not_letters(spark):
    train = spark.createDataFrame([(i, "el agua y la casa", "es") for i in range(20)], "doc_id long, text string, lang string")
    texts = ["×", "12 ÷ 3", "×× 5", "ª", "5 × agua"]
    got = language_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").orderBy("doc_id"), language_id.fit(train))
    assert [r["lang_pred"] for r in got.orderBy("c0").collect()] == ["und", "und", "und", "es", "es"]


def test_keys_named_like_results_are_refused(spark):
    df = spark.createDataFrame([(1, "http://a.net/")], "slot long, url string")
    with pytest.raises(ValueError, match="slot"):
        sharding.place(df, ["a", "b"], 7, keys=("slot",))
    with pytest.raises(ValueError, match="host"):
        url_filter.filter_urls(df.withColumnRenamed("slot", "Host"), [("net/", "block")], keys=("Host",))
