"""Operator 2: language identification of whole texts, with spans.

Script ranges narrow the languages that a word can belong to; each word is
scored under those by its byte trigrams and, where it is known, by the word
itself; a Viterbi pass over a text's words with a penalty for every switch
labels runs of words. The language of most letters is the prediction, its
share of the letters the score.

The model is counted from at most ``PER_LANG`` labelled documents of each
language (those with the smallest id hashes, so at any size the same rule) and
keeps at most ``TOP_WORDS`` words and ``TRIGRAM_SLOTS`` trigram slots of each:
that bounds what is collected and broadcast by the number of languages. Every
text is labelled whole.

Defined cases: a null text, an empty text or one without a letter: ``und``,
score 0, no spans; a text whose letters no learned language uses: the language
with most learned words, score 0; null ids are treated as the empty text by
the hold-out rule; repeated rows are labelled each for itself; no labelled row:
``und``, score 0 for every text; an empty table of texts: empty result. Equal shares: the smaller
language value. Carried columns travel under positional names, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm import common

PER_LANG, TOP_WORDS, TRIGRAM_SLOTS = 400, 20_000, 1 << 15
#: Parts of a language that are ranked apart.
FIT_PARTS = 64
#: Log-likelihood paid for a change of language, and the most that one word can say against one.
SWITCH, WORST = 8.0, 12.0
#: A language's script holds at least this share of its learned words.
SCRIPT_SHARE = 0.005
VITERBI_CELLS = 400_000
#: Bytes of text labelled together.
PASS = 1_000_000

# FIXED VALUES: first and last code point of the scripts that are told apart.
SCRIPTS = [
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xAA, 0xAA), ("latin", 0xBA, 0xBA), ("latin", 0xC0, 0xD6),
    ("latin", 0xD8, 0xF6), ("latin", 0xF8, 0x2AF),
    ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x531, 0x58F), ("hebrew", 0x591, 0x5F4),
    ("arabic", 0x600, 0x6FF), ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("sinhala", 0xD80, 0xDFF), ("thai", 0xE00, 0xE7F),
    ("lao", 0xE80, 0xEFF), ("tibetan", 0xF00, 0xFFF), ("burmese", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF), ("mongolian", 0x1800, 0x18AF),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x2FA1F),
]
SCRIPT_NAMES = ["none", *dict.fromkeys(s for s, _, _ in SCRIPTS)]
_EDGES = np.array([x for _, a, b in SCRIPTS for x in (a, b + 1)])
_IDS = np.array([x for s, _, _ in SCRIPTS for x in (SCRIPT_NAMES.index(s), 0)], dtype=np.uint8)

_WORD = np.zeros(256, dtype=bool)
_WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def script_of(cp: np.ndarray) -> np.ndarray:
    at = np.searchsorted(_EDGES, cp, side="right") - 1
    return np.where(at < 0, np.uint8(0), _IDS[np.maximum(at, 0)])


def byte_scripts(data: np.ndarray) -> np.ndarray:
    """Script of the character that starts at each byte (0: none, or inside a character)."""
    out = script_of(np.arange(128))[np.minimum(data, 127)] * (data < 128)
    at = np.flatnonzero(data >= 0xC2)
    if len(at):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        b0, b1, b2, b3 = (padded[at + i] for i in range(4))
        two = (b0 & 0x1F) << 6 | (b1 & 0x3F)
        three = (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | (b2 & 0x3F)
        four = (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | (b3 & 0x3F)
        out[at] = script_of(np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four)))
    return out.astype(np.uint8)


@dataclass
class Words:
    """The words of one pass: row, byte span, hash, script and letter weight."""
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    script: np.ndarray
    data: np.ndarray


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    s, e = common.spans(_WORD[data], offsets[:-1])
    h = common.span_hash(common.prefix_hash(data, True), s, e)
    script = np.maximum.reduceat(byte_scripts(data), s) if len(s) else np.zeros(0, np.uint8)
    return Words(np.searchsorted(offsets, s, side="right") - 1, s, e, h, script, _LOWER[data])


def trigrams(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram slots of the chosen words, one per byte (edges read as a space), and the index of each one's word."""
    n = (w.end - w.start)[which]
    owner = np.repeat(np.arange(len(which)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + w.start[which][owner]
    d = w.data
    before = np.where(at > w.start[which][owner], d[np.maximum(at - 1, 0)], 32).astype(np.uint64)
    after = np.where(at + 1 < w.end[which][owner], d[np.minimum(at + 1, len(d) - 1)], 32).astype(np.uint64)
    key = before << np.uint64(16) | d[at].astype(np.uint64) << np.uint64(8) | after
    return (common.mix(key + np.uint64(1)) % np.uint64(TRIGRAM_SLOTS)).astype(np.int64), owner


@dataclass
class Model:
    """Log-probabilities by language (languages in ascending order)."""
    langs: list[str]
    words: np.ndarray       # sorted hashes
    word_scores: np.ndarray  # (words, languages)
    trigram_scores: np.ndarray  # (slots, languages)
    allowed: np.ndarray     # (scripts, languages)
    most_common: int

    def scores(self, w: Words) -> np.ndarray:
        """Score of each word under each language: 0 for the best, at least -WORST."""
        _, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        slot, owner = trigrams(w, first)
        s = np.zeros((len(first), len(self.langs)))
        for k in range(len(self.langs)):
            s[:, k] = np.bincount(owner, weights=self.trigram_scores[slot, k], minlength=len(first))
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, w.hash[first]), len(self.words) - 1)
            known = self.words[at] == w.hash[first]
            s[known] += self.word_scores[at[known]]
        s = np.where(self.allowed[w.script[first]], s, -np.inf)
        says = self.says(w.script[first])
        s[~says] = 0
        return np.maximum(s - s.max(axis=1, keepdims=True), -WORST)[inverse]

    def says(self, script: np.ndarray) -> np.ndarray:
        """Whether a word of this script says anything: some learned language uses the script."""
        return (script > 0) & self.allowed.any(axis=1)[script]


def viterbi(scores: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Best language of each word: texts of similar length go through the recurrence together."""
    labels = np.zeros(len(scores), dtype=np.uint8 if scores.shape[1] < 256 else np.int32)
    order = np.flatnonzero(n)[np.argsort(n[np.flatnonzero(n)], kind="stable")][::-1]
    own = np.arange(scores.shape[1])
    i = 0
    while i < len(order):
        steps = int(n[order[i]])
        group = order[i:i + max(1, min(512, VITERBI_CELLS // steps))]
        i += len(group)
        inside = np.arange(steps)[:, None] < n[group]
        at = np.where(inside, first[group] + np.arange(steps)[:, None], 0)
        emit = scores[at] * inside[:, :, None]
        back = np.empty(emit.shape, dtype=labels.dtype)
        best = emit[0]
        for t in range(1, steps):
            top = best.argmax(axis=1)
            switched = best[np.arange(len(group)), top] - SWITCH
            back[t] = np.where(best >= switched[:, None], own, top[:, None])
            best = np.maximum(best, switched[:, None]) + emit[t]
        state = best.argmax(axis=1)
        path = np.empty((steps, len(group)), dtype=labels.dtype)
        for t in range(steps - 1, -1, -1):
            path[t] = state
            if t:
                state = back[t][np.arange(len(group)), state]
        labels[at[inside]] = path[inside]
    return labels


def hold_out(id_col: str = "doc_id") -> Column:
    """The fixed fifth of the ids that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG) -> Model:
    """Learn from the text and non-null language of the documents that are not held out."""
    common.ship(docs.sparkSession)
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~hold_out(id_col))
    # The smallest hashes of each part of a language, then of these: no task ranks a whole language.
    part = F.pmod(F.col("h"), F.lit(FIT_PARTS))
    picked = labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("h")).withColumn("part", part)
    for by in (["lang", "part"], ["lang"]):
        picked = (picked.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("h", "id")))
                  .where(F.col("rank") <= per_lang).drop("rank"))
    picked = picked.select("lang", "id").distinct()
    # At most per_lang ids of each language: broadcast instead of shuffling the texts.
    sample = (labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .join(F.broadcast(picked), ["lang", "id"], "left_semi"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), dtype=object)
            data, offsets = common.text_column(b, "text")
            for lo, hi in common.passes(offsets):
                w = read_words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                for lang in sorted(set(langs[lo:hi])):
                    mine = np.flatnonzero((langs[lo:hi] == lang)[w.row])
                    slot, _ = trigrams(w, mine)
                    for kind, keys in enumerate((w.hash[mine].view(np.int64), slot, w.script[mine].astype(np.int64))):
                        key, n = np.unique(keys, return_counts=True)
                        yield pa.record_batch([pa.array([lang] * len(key), pa.string()), pa.array([kind] * len(key), pa.int32()),
                                               pa.array(key, pa.int64()), pa.array(n, pa.int64())],
                                              names=["lang", "kind", "key", "n"])

    counts = (sample.select("lang", "text").mapInArrow(count, "lang string, kind int, key long, n long")
              .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    top = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    rows = (counts.withColumn("rank", top).where(F.col("rank") <= F.greatest(F.lit(TOP_WORDS), F.lit(TRIGRAM_SLOTS)))
            .where((F.col("kind") != 0) | (F.col("rank") <= TOP_WORDS)).drop("rank").toPandas())
    if rows.empty:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros((TRIGRAM_SLOTS, 0)), np.zeros((len(SCRIPT_NAMES), 0), bool), 0)
    langs = sorted(rows["lang"].unique())
    index = rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    kind, key, n = (rows[c].to_numpy() for c in ("kind", "key", "n"))

    def by_language(k: int, slots: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros((size, len(langs)))
        np.add.at(out, (slots, index[kind == k]), n[kind == k])
        return out

    words = np.unique(key[kind == 0].view(np.uint64))
    word = by_language(0, np.searchsorted(words, key[kind == 0].view(np.uint64)), len(words))
    trigram = by_language(1, key[kind == 1], TRIGRAM_SLOTS)
    script = by_language(2, key[kind == 2], len(SCRIPT_NAMES))
    allowed = script >= SCRIPT_SHARE * script.sum(axis=0)
    return Model(langs, words, np.log((word + 0.5) / (word.sum(axis=0) + 0.5 * (len(words) + 1))),
                 np.log((trigram + 0.5) / (trigram.sum(axis=0) + 0.5 * TRIGRAM_SLOTS)), allowed,
                 int(script.sum(axis=0).argmax()))


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def label(model: Model, texts: pa.RecordBatch, name: str) -> tuple[list[str], list[float], pa.Array]:
    """Prediction, score and spans (in characters) of each text of a batch."""
    if not model.langs:
        return ["und"] * texts.num_rows, [0.0] * texts.num_rows, pa.array([[]] * texts.num_rows, SPANS)
    data, offsets = common.text_column(texts, name)
    langs, scores, spans = [], [], []
    names = pa.array(model.langs, pa.string())
    for lo, hi in common.passes(offsets, PASS):
        part, own = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        w = read_words(part, own)
        n = np.bincount(w.row, minlength=hi - lo)
        first = np.cumsum(n) - n
        path = viterbi(model.scores(w), first, n) if len(w.row) else np.zeros(0, np.uint8)
        weight = np.where(model.says(w.script), w.end - w.start, 0)
        share = np.zeros((hi - lo, len(model.langs)))
        np.add.at(share, (w.row, path), weight)
        total, best = share.sum(axis=1), share.argmax(axis=1)
        plain = np.zeros(hi - lo, dtype=bool)
        plain[w.row[w.script == SCRIPT_NAMES.index("latin")]] = True
        lettered = plain.copy()
        for i in np.flatnonzero(~plain & (n > 0)):  # no Latin letter: look at the characters themselves
            lettered[i] = any(c.isalpha() for c in part[own[i]:own[i + 1]].tobytes().decode("utf-8", "replace"))
        for i in range(hi - lo):
            langs.append("und" if not lettered[i] else model.langs[best[i] if total[i] else model.most_common])
            scores.append(float(share[i, best[i]] / total[i]) if lettered[i] and total[i] else 0.0)
        # A span is a run of words of one text with one label.
        keep = lettered[w.row]
        row, lab, s, e = w.row[keep], path[keep], w.start[keep], w.end[keep]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (lab[1:] != lab[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(row))[:len(head)] - 1
        chars = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        base = chars[own[row[head]]]
        items = pa.StructArray.from_arrays([names.take(pa.array(lab[head].astype(np.int64))),
                                            pa.array(chars[s[head]] - base, pa.int64()),
                                            pa.array(chars[e[tail]] - base, pa.int64())], names=["lang", "start", "end"])
        spans.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(row[head], np.arange(hi - lo + 1)), pa.int32()), items))
    return langs, scores, pa.concat_arrays(spans) if spans else pa.array([], SPANS)


def identify(docs: DataFrame, model: Model, text_col: str = "text", carry: Sequence[str] = ("doc_id",),
             with_spans: bool = False) -> DataFrame:
    """The carried columns (as ``c0``, ``c1``, ...), lang_pred, score and n_spans of every
    row; with ``with_spans`` also the spans themselves."""
    common.ship(docs.sparkSession)
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    inside = text_col in carry  # then the text travels once
    rows = docs.select(*carried) if inside else docs.select(*carried, F.col(text_col).alias("text"))
    name = f"c{list(carry).index(text_col)}" if inside else "text"
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of languages
    fields = [f"c{i} {t}" for i, (_, t) in enumerate(rows.dtypes[:len(carry)])]
    more = ["lang_pred string", "score double", "n_spans int"] + ["spans array<struct<lang:string,start:long,end:long>>"] * with_spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.enter("language_id")
        for b in batches:
            langs, scores, spans = label(shipped.value, b, name)
            cols = b.columns[:len(carry)] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                             spans.value_lengths().cast(pa.int32())] + [spans] * with_spans
            yield pa.record_batch(cols, names=[f"c{i}" for i in range(len(carry))] + [m.split()[0] for m in more])

    return rows.mapInArrow(run, ", ".join(fields + more))
