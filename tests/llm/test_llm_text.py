"""Operators over texts against brute force, with nulls, empties, long texts, repeats and clashing columns."""

import base64
import hashlib
import random
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartlens.llm import byte_bpe, common, decontamination, jaccard_join, language_id, queries, sharding, suffix_dedup, token_counts

DOCS = "doc_id long, text string, lang string, n_tokens int, `key` string, c0 string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words(rnd, n, k=400):
    return [f"w{rnd.randrange(k)}" for _ in range(n)]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, None, 7, "k", "c") for i, t in zip(ids, texts, strict=True)], DOCS).repartition(3)


def corpus(seed=1):
    """Copies, near copies, shared passages, self-repeats, empties, nulls, odd characters."""
    r = random.Random(seed)
    base = [words(r, r.choice([3, 6, 40, 200, 500])) for _ in range(40)]
    passage = " ".join(words(r, 120, 10**6))
    texts = [" ".join(b) for b in base] + [" ".join(b) for b in base[:10]]
    for b in base[5:25]:
        near = list(b)
        for _ in range(max(1, len(near) // 60)):
            near[r.randrange(len(near))] = "edit"
        texts.append(" ".join(near))
    texts += [" ".join(words(r, 30)) + " " + passage + " " + " ".join(words(r, 30)) for _ in range(6)]
    texts += [None, "", " \n\t", "one", "ONE", "a b c d", "A  b\tc d", "x" * 3000, "ab" * 900, "é" * 700, "日本語 " * 300, "\0\0 a"]
    texts += ["1 2 3 … !?", "line again\n" * 200]
    return texts


def brute_components(rows):
    sets = []
    for _, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for sep in "\t\n\x0b\x0c\r":
            low = low.replace(sep, " ")
        w = [x for x in low.split(" ") if x]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in groups[find(i)] if x is not None]
        out.append((doc_id, len(sets[i]), min(known) if known else None))
    return Counter(out)


@pytest.mark.parametrize("block", [128, 4])
def test_jaccard_join(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = corpus()
    r = random.Random(5)
    core = words(r, 150)
    for k in range(25):  # a chain of near copies, each further from the first
        core = list(core)
        core[(7 * k) % 150] = f"chain{k}"
        texts.append(" ".join(core))
    ids = list(range(len(texts) - 3)) + [5, 5, None]
    df = frame(spark, texts, ids)
    got = Counter(tuple(x) for x in jaccard_join.join(df).collect())
    assert got == brute_components(list(zip(ids, texts, strict=True)))
    assert jaccard_join.join(df.limit(0)).collect() == []


def test_one_of_each_keeps_one_row_per_group(spark):
    texts = corpus()
    kept = jaccard_join.one_of_each(frame(spark, texts))
    assert kept.columns == frame(spark, texts).columns
    parts = {}
    for x in jaccard_join.join(frame(spark, texts)).collect():
        parts.setdefault(x["component_id"], []).append(x["doc_id"])
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(min(v) for v in parts.values())


def brute_repeats(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1000, 1])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = corpus(2)
    ids = list(range(len(texts) - 2)) + [None, 0]
    df = frame(spark, texts, ids)
    got = Counter((x["c0"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in suffix_dedup.dedup(df).collect())
    assert got == Counter((i, *b) for i, b in zip(ids, brute_repeats(texts), strict=True))
    assert suffix_dedup.dedup(df.limit(0)).collect() == []


def test_suffix_dedup_carries_columns(spark):
    df = frame(spark, ["q" * 900, "short"])
    out = {x["c0"]: x for x in suffix_dedup.dedup(df, carry=("doc_id", "key", "c0"), with_text=True).collect()}
    assert (out[0]["n_removed"], out[0]["kept"], out[1]["kept"], out[1]["c1"], out[1]["c2"]) == (900, "", "short", "k", "c")


def plain_tokens(text):
    """Start and end character of every word, one character at a time."""
    out, open_ = [], False
    for i, ch in enumerate(text):
        c, cat = ord(ch), unicodedata.category(ch)
        gap = not ch.isalnum() if c < 128 else cat[0] in "PZ" or cat == "Cc" or c in (0x200B, 0x2060, 0xFEFF)
        alone = not gap and any(x <= c <= y for x, y in common.UNSPACED)
        if not gap and open_ and not alone:
            out[-1][1] = i + 1
        elif not gap:
            out.append([i, i + 1])
        open_ = not gap and not alone
    return out


def test_tokens_against_single_characters():
    import numpy as np
    import pyarrow as pa
    r = random.Random(8)
    some = "ab Z9'é’«»ñ— …\u3000、。漢字かなカーดกำ한국語ﾊﾟ😀𠀀\u200b\n_"
    texts = ["".join(r.choices(some, k=r.randrange(30))) for _ in range(300)] + ["", "漢", "é"]
    data, offsets = common.text_column(pa.record_batch([pa.array(texts)], names=["text"]), "text")
    s, e, row = common.tokens(data, offsets)
    got = [(int(k), data[a:b].tobytes().decode()) for a, b, k in zip(s, e, row, strict=True)]
    assert got == [(k, t[a:b]) for k, t in enumerate(texts) for a, b in plain_tokens(t)]
    assert len(common.tokens(np.frombuffer(b"a \xe6\xbc", np.uint8), np.array([0, 4]))[0]) == 2  # broken end


def brute_passages(texts, n):
    """What is left of each text without the strings of n words that stand elsewhere too."""
    found = [plain_tokens(t or "") for t in texts]
    strings = [[t[w[i][0]:w[i + n - 1][1]] for i in range(len(w) - n + 1)] for t, w in zip(texts, found, strict=True)]
    seen = Counter(x for s in strings for x in s)
    out = []
    for t, w, s in zip(texts, found, strings, strict=True):
        gone = bytearray(len(t or ""))
        for i, x in enumerate(s):
            if seen[x] > 1:
                gone[w[i][0]:w[i + n - 1][1]] = b"\1" * len(x)
        out.append("".join(ch for ch, g in zip(t or "", gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("hot, n", [(1000, 51), (1, 51), (1, 3)])
def test_repeated_passages_in_words(spark, monkeypatch, hot, n):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    r = random.Random(4)
    texts = corpus(2)
    short = " ".join(r.choices("abcdefgh", k=51))  # 101 bytes
    one, two = (" ".join(words(r, 30, 10**6)) for _ in range(2))
    han = "".join(chr(0x4E00 + r.randrange(5000)) for _ in range(60))
    texts += [f"first ({short}). x", f"second {short}, y", "z " + short[2:] + " fifty only", one + " " + two, one + " p", "q " + two,
              "前" + han + "。後", "他、" + han, "x, y; " * 80, "x, y; " * 30]
    got = {x["c0"]: x["kept"] for x in suffix_dedup.dedup(frame(spark, texts), words=n, with_text=True).collect()}
    assert got == dict(enumerate(brute_passages(texts, n)))
    if n == 51:
        assert got[len(texts) - 10] == "first (). x" and got[len(texts) - 7] == one + " " + two  # each half repeats, of 30 words
        assert got[len(texts) - 4] == "前。後"


def test_passages_of_words_beside_byte_strings(spark):
    """Passages of 51 short words fill no 400 bytes: they are reported, and nothing is removed for them."""
    r = random.Random(14)
    texts = corpus(3)
    short, shorter = (" ".join(r.choices("abcdefghijkl", k=k)) for k in (51, 50))
    texts += [f"one {short} two é", f"three {short}", f"four {shorter} five", f"six {shorter} seven", f"{short}\n\né {short}", None, ""]
    got = {x["c0"]: x for x in suffix_dedup.dedup(frame(spark, texts), passages=51).collect()}
    for i, (want, left) in enumerate(zip(brute_repeats(texts), brute_passages(texts, 51), strict=True)):
        x, t = got[i], texts[i] or ""
        assert (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) == want
        assert x["passage_bytes"] == len(t.encode()) - len(left.encode()) and (x["n_passages"] > 0) == (left != t)
    n = len(texts)
    assert [got[i]["n_passages"] for i in range(n - 7, n)] == [1, 1, 0, 0, 2, 0, 0] and got[n - 7]["n_removed"] == 0
    assert got[n - 7]["passage_bytes"] == len(short)


def test_final_cut_reads_the_words_of_marked_texts_only(monkeypatch):
    """Texts without marks are not split into words again, and no hashes are made for the others."""
    texts = [b"no marks here, " * 20, b"x, a b  c d", b"none", "é a b c".encode(), b""]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    spans = [np.array(p, np.int64).tobytes() for p in ([[0, 1], [3, 5]], [[2, 3]])]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("starts", pa.int64()), ("spans", pa.binary())]))
    pieces = pa.array([[], [{"first": 0, "starts": 9, "spans": spans[0]}], None,
                       [{"first": 0, "starts": 1, "spans": None}, {"first": 0, "starts": 9, "spans": spans[1]}], []], kind)
    read, tokens = [], common.tokens
    monkeypatch.setattr(common, "tokens", lambda data, offsets: (read.append(len(data)), tokens(data, offsets))[1])
    monkeypatch.setattr(common, "prefix_hash", None)
    cuts = suffix_dedup._cuts(pieces, np.zeros_like(offsets), 3)  # passages of two words: entries 0 to 2, 2 to 4, ...
    covered = suffix_dedup._covered(data, offsets, (0, 5), cuts, 2)
    got = [bytes(np.where(covered[a:z], 42, data[a:z]).astype(np.uint8)) for a, z in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [texts[0], b"**** **** d", b"none", b"****** c", b""]
    assert read == [len(texts[1]) + len(texts[3])]


def test_pipeline_cuts_51_short_words_and_keeps_50(spark):
    r = random.Random(6)
    short, shorter, whole = (" ".join(r.choices("abcdefghijkl", k=k)) for k in (51, 50, 60))
    texts = [f"one {short} two", f"three {short} four", f"five {shorter} six", f"seven {shorter} eight", whole + ".", whole + "!"]
    out = corpus_pipeline.repeated_passages(spark, frame(spark, texts), "")
    assert sorted(x["text"] for x in out.collect()) == sorted(["one  two", "three  four", texts[2], texts[3]])


def test_byte_bpe(spark):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = corpus(3) + ["it's I'LL <|endoftext|>  \n\n x", "abc" * 2000, "\x1c\x85  \u3000 x", "😀" * 300, "0123456789" * 40]
    df = frame(spark, texts, [None, 1, 1] + list(range(3, len(texts))))
    rows = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, with_ids=True)
    want = Counter()
    for t in texts:
        ids = enc.encode_ordinary(t or "")
        want[(len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    got = rows.collect()
    assert Counter((x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) for x in got) == want
    back = byte_bpe.decode(rows, RANKS).collect()
    assert Counter(bytes(x["content"]).decode() for x in back) == Counter(t or "" for t in texts)
    assert byte_bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_token_counts_and_cache(spark, tmp_path):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = corpus(4)
    df, cache = frame(spark, texts), str(tmp_path / "cache")
    want = {i: (len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 100) for i, t in enumerate(texts)}
    for _ in range(2):  # the second time everything is in the cache
        got = {x["doc_id"]: tuple(x)[1:] for x in token_counts.count_tokens(df, path, cache, limit=100).collect()}
        assert got == want
        assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    more = token_counts.count_tokens(frame(spark, texts + ["a new text"]), path, cache)
    assert more.count() == len(texts) + 1
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts}) + 1
    assert token_counts.count_tokens(df.limit(0), path).collect() == []


def test_token_counts_json(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    texts = ["The cat", None, "<|endoftext|> x", "a" * 500]
    got = {x["doc_id"]: x["n_tokens"] for x in token_counts.count_tokens(frame(spark, texts), path).collect()}
    assert got == {i: len(tk.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_language_id(spark):
    r = random.Random(1)
    vocab = {"aa": ["the", "and", "with", "house", "water"], "bb": ["der", "und", "nicht", "haus", "wasser"], "ru": ["дом", "вода", "нет"]}
    rows = [(i, " ".join(r.choices(vocab[lang], k=40)), lang, 1, "k", "c") for i, lang in enumerate(["aa", "bb", "ru"] * 30)]
    train = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(train)
    assert model.langs == ["aa", "bb", "ru"]
    mixed = " ".join(["the water and house"] * 6 + ["und nicht wasser der haus"] * 4)
    texts = [None, "", "12 … !", "the house", "вода нет", "日本", mixed, "the water " * 20000]
    got = [x for x in language_id.identify(frame(spark, texts), model, carry=("doc_id", "c0"), with_spans=True).orderBy("c0").collect()]
    assert [x["lang_pred"] for x in got] == ["und", "und", "und", "aa", "ru", got[5]["lang_pred"], "aa", "aa"]
    assert got[5]["lang_pred"] in model.langs and got[5]["score"] == 0
    assert got[1]["c1"] == "c"
    assert [(s["lang"], mixed[s["start"]:s["end"]].split()[0]) for s in got[6]["spans"]] == [("aa", "the"), ("bb", "und")]
    assert 0.5 < got[6]["score"] < 0.6 and got[7]["n_spans"] == 1 and got[7]["score"] == 1
    assert language_id.identify(train.limit(0), model).collect() == []
    nothing = language_id.fit(train.withColumn("lang", F.lit(None).cast("string")))
    assert {x["lang_pred"] for x in language_id.identify(train, nothing).collect()} == {"und"}


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identify(docs, language_id.fit(docs), carry=("doc_id", "lang")).where(language_id.hold_out("c0"))
    assert out.where("lang_pred = c1").count() >= 0.97 * out.count()


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np
    r = np.random.default_rng(3)
    for n in range(1, 7):
        s = -r.random((n, 3)) * 20
        path = language_id.viterbi(s, np.array([0]), np.array([n]))

        def value(p, s=s):
            return sum(s[i, x] for i, x in enumerate(p)) - language_id.SWITCH * sum(a != b for a, b in zip(p, p[1:], strict=False))
        assert value(path.tolist()) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=n)))


def brute_tiles(doc, item, least):
    used_d, used_i, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best, found = least - 1, []
        for d in range(len(doc)):
            for i in range(len(item)):
                k = 0
                while d + k < len(doc) and i + k < len(item) and doc[d + k] == item[i + k] and not used_d[d + k] and not used_i[i + k]:
                    k += 1
                if k > best:
                    best, found = k, []
                if k == best and k >= least:
                    found.append((d, i))
        if not found:
            return total
        for d, i in found:
            if not any(used_d[d:d + best]) and not any(used_i[i:i + best]):
                used_d[d:d + best] = used_i[i:i + best] = [True] * best
                total += best


def test_tiling_against_brute_force():
    import numpy as np
    r = random.Random(3)
    for _ in range(200):
        k = r.choice([2, 3, 8])
        doc, item = ([r.randrange(k) for _ in range(r.randrange(n))] for n in (60, 40))
        got = decontamination.tile(np.array(doc, np.uint64), np.array(item, np.uint64), np.ones(len(doc), bool))
        assert sum(t[0] for t in got) == brute_tiles(doc, item, 5)


def test_decontamination(spark):
    r = random.Random(9)
    items = [words(r, 40, 10**6) for _ in range(5)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(9, None), (10, "too short"), (3, " ".join(items[3]))], "item_id int, text string")
    far = [" ".join(words(r, 200)) for _ in range(4)]
    halves = items[1][20:] + ["between"] + items[1][:20]
    texts = [far[0] + " " + " ".join(items[0]).upper() + "! " + far[1], far[0], " ".join(halves), None, "",
             far[2] + " " + " ".join(items[2][:10]) + " " + far[3], " , ".join(items[3]), "too short"]
    df = frame(spark, texts)
    got = {(x["doc_id"], x["item_id"]): x for x in decontamination.find(df, bench).collect()}
    assert set(got) == {(0, 0), (2, 1), (6, 3)}
    assert got[2, 1]["n_tiles"] == 2 and got[2, 1]["coverage"] == 1.0
    left = decontamination.drop(df, bench)
    assert left.columns == df.columns and sorted(x["doc_id"] for x in left.collect()) == [1, 3, 4, 5, 7]
    assert decontamination.find(df.limit(0), bench).collect() == []
    assert decontamination.find(df, bench.limit(0)).collect() == []
    assert decontamination.drop(df, bench.limit(0)).count() == len(texts)


def test_decontamination_of_unspaced_scripts_and_short_items(spark, tmp_path):
    r = random.Random(12)
    far = [" ".join(words(r, 100)) for _ in range(2)]
    han, thai = "今天我们去公园看花，然后回家吃饭。", "วันนี้ฝนตกหนักมาก"
    bench = spark.createDataFrame([(0, han), (1, thai), (2, "three short words"), (3, "水"), (4, "three short words"), (5, "。"), (6, "")], "item_id int, text string")
    texts = ["昨天下雨。" + han + "晚上看书", far[0] + han[:9] + far[1], "ก่อน" + thai + "หลัง", "so Three, short words here", "three short word s",
             "three short", "喝水吧", "three short words", far[0], han.replace("，", " ")]
    docs = frame(spark, texts)
    want = {(0, 0), (1, 0), (9, 0), (2, 1), (3, 2), (3, 4), (7, 2), (7, 4), (6, 3)}
    got = decontamination.find(docs, bench, short=True).collect()
    assert Counter((x["doc_id"], x["item_id"]) for x in got) == Counter(want)
    assert {(x["coverage"], x["n_tiles"], x["longest_tile"]) for x in got if x["item_id"] in (2, 4)} == {(1.0, 1, 3)}
    assert {x["doc_id"] for x in decontamination.find(docs, bench).collect()} == {0, 1, 2, 9}  # whole items only on request
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert Counter((x["doc_id"], x["item_id"]) for x in queries.QUERIES["op3_decontamination"](spark, str(tmp_path)).collect()) == Counter(want)
    assert sorted(x["doc_id"] for x in corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path)).collect()) == [4, 5, 8]


def test_sharding(spark):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 997)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    # Losing a shard moves its slots and few others.
    less = sharding.lookup_table(names[:-1], 997)
    moved = sum(a != b for a, b in zip(table, less, strict=True) if a != 6)
    assert moved < 0.25 * 997
    weighted = Counter(sharding.lookup_table(["a", "b"], 997, [3, 1]))
    assert 2.8 < weighted[0] / weighted[1] < 3.2
    df = frame(spark, ["t"] * 50, [None] * 5 + list(range(45)))
    rows = sharding.place(df, names, 997).collect()
    assert len(rows) == 50 and all(x["shard"] == names[table[x["slot"]]] for x in rows)
    assert len({x["slot"] for x in rows if x["doc_id"] is None}) == 1
    assert sharding.place(df.limit(0), names, 997).collect() == []
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)


def test_write_shards(spark, tmp_path):
    names = ["a", "b", "c"]
    df = frame(spark, corpus(6))
    sharding.write_shards(df, str(tmp_path / "out"), names, 101, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    placed = {x["doc_id"]: x["shard"] for x in sharding.place(df, names, 101).collect()}
    assert {x["doc_id"]: x["shard"] for x in back.select("doc_id", "shard").collect()} == placed


def test_pipeline_run_against_chained_brute_force(spark, tmp_path):
    import tiktoken
    r = random.Random(21)

    def vocabulary(letters, k):
        return ["".join(r.choices(letters, k=r.randrange(1, 8))) for _ in range(k)]

    tongue = {"aa": vocabulary("abcdefg", 300), "bb": vocabulary("nopqrst", 300)}
    items = [r.choices(vocabulary("abcdefg", 4000), k=30) for _ in range(4)] + [["fed", "cab", "bagdad"]]
    passages = {n: " ".join(r.choices("abcdefg", k=n)) for n in (50, 51, 70)}
    rows = []

    def add(lang, text):
        rows.append((len(rows), text, lang, "s", len(text or "")))

    def some(lang, n):
        return " ".join(r.choices(tongue[lang], k=n))

    for lang in ("aa", "bb"):
        for _ in range(25):
            add(lang, some(lang, r.choice([60, 120, 200])))
        for i in range(4):  # copies and near copies of a long text
            long = some(lang, 150).split(" ")
            add(lang, " ".join(long))
            add(lang, " ".join(long))
            long[70 + i] = "edit"
            add(None, " ".join(long))
    for text in passages.values():
        for k in range(3):
            add("aa", f"{some('aa', 40)}. {text}, {some('aa', 40 + k)}")
    add("aa", passages[70] + "!")  # nothing else: it goes
    for item in items:
        add("aa", f"{some('aa', 50)}; {' '.join(item)} {some('aa', 50)}")
    add("aa", " ".join(items[1][15:] + [some("aa", 60)] + items[1][:15]))
    add("aa", " ".join([some("aa", 80)] + items[2][:12]))  # too little of it
    for text in (None, "", "12 34 !!"):
        add("aa", text)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id int, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))

    now = [(i, t) for i, t, *_ in rows if any(ch.isalpha() for ch in t or "")]
    first = {i: c for i, _, c in brute_components(now)}
    unique = [(i, t) for i, t in now if first[i] == i]
    left = brute_passages([t for _, t in unique], corpus_pipeline.PASSAGE)
    cut = [(i, new) for (i, old), new in zip(unique, left, strict=True) if new == old or any(ch.isalnum() for ch in new)]

    def leaked(text):
        doc = [text[a:b].lower() for a, b in plain_tokens(text)]
        for item in items:
            n = len(item)
            if n < 5 and any(doc[k:k + n] == item for k in range(len(doc) - n + 1)) or n >= 5 and 2 * brute_tiles(doc, item, 5) >= n:
                return True
        return False

    clean = [(i, t) for i, t in cut if not leaked(t)]
    assert len(rows) > len(now) > len(unique) > len(cut) > len(clean) > 50  # every stage has work
    assert sum(a != b for (_, a), b in zip(unique, left, strict=True)) == 7  # texts with a passage of 51 or 70 words
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: enc.encode_ordinary(t) for i, t in clean}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == len(want) and {x["doc_id"]: list(x["ids"]) for x in out} == want
    for x in out:
        text = dict(clean)[x["doc_id"]]
        assert (x["n_tokens"], x["decoded_sha256"]) == (len(want[x["doc_id"]]), hashlib.sha256(text.encode()).hexdigest())
        assert x["ids_sha256"] == hashlib.sha256(" ".join(map(str, want[x["doc_id"]])).encode()).hexdigest()
