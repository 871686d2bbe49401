"""Language identification: n-gram filters that answer with the bitmask of all languages that hold an n-gram."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerline.llm.shingles import batches, mixed
from ledgerline.llm.store import written

SIZES = (2, 3, 4)  # characters of an n-gram
SLOTS = 1 << 16  # of the filter, for every 64 languages
HASHES = 3
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point 2 for a letter, 1 for a mark, else 0."""
    if not _letters:
        _letters.append(np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.int8))
    return _letters[0]


def letter_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, whether the text has a letter): the n-grams of lower-case words, with one space on either side of each word."""
    points = [np.frombuffer(f" {(t or '').lower()} ".encode("utf-32-le", "replace"), "<u4") for t in texts]
    flat = np.concatenate(points) if points else np.zeros(0, np.uint32)
    text = np.repeat(np.arange(len(points)), [len(p) for p in points])
    kind = _letter_table()[flat]
    base = np.maximum.accumulate(np.where(kind != 1, np.arange(len(flat)), 0))  # a mark belongs to what it stands on
    letter = kind[base] == 2 if len(flat) else kind == 2
    keep = letter.copy()  # of a run of other characters one is kept, as a space
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    first = np.ones(len(flat), bool)
    first[1:] = letter[1:] | letter[:-1] | (text[1:] != text[:-1])
    flat, text = np.where(letter, flat, 0x20)[keep & first].astype(np.uint64), text[keep & first]
    space = flat == 0x20
    hashes, of = [], []
    for n in SIZES:
        m = len(flat) - n + 1
        if m <= 0:
            continue
        value = np.zeros(m, np.uint64)
        for i in range(n):
            value = (value << np.uint64(21)) ^ flat[i : i + m] if i < 3 else mixed(value) ^ flat[i : i + m]
        inner = np.zeros(m, bool)
        for i in range(1, n - 1):
            inner |= space[i : i + m]
        good = ~inner & (text[:m] == text[n - 1 :]) & ~(space[:m] & space[n - 1 :])
        hashes.append(mixed(value[good] * np.uint64(8) + np.uint64(n)))
        of.append(text[:m][good])
    has = np.zeros(len(points), bool)
    has[text[~space]] = True
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(of or [np.zeros(0, np.int64)]), has


def _places(hashes: np.ndarray) -> list[np.ndarray]:
    step = mixed(hashes ^ np.uint64(0xA5A5A5A5)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) >> np.uint64(48)).astype(np.int64) % SLOTS for i in range(HASHES)]


@dataclass(frozen=True)
class Filters:
    """langs: the names of the bits; table: a word of bits for each slot and 64 languages; wrong: false-positive rate by language."""

    langs: list[str]
    table: np.ndarray
    wrong: np.ndarray

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that hold it, as bits; some others by accident."""
        first, *rest = [self.table[p] for p in _places(hashes)]
        for other in rest:
            first = first & other
        return first


def build(langs: list[str], grams: list[tuple[int, int]]) -> Filters:
    """grams: (index of the language, signed hash)."""
    table = np.zeros((SLOTS, max(1, -(-len(langs) // 64))), np.uint64)
    if grams:
        which, hashes = np.array([g[0] for g in grams]), np.array([g[1] for g in grams], np.int64).view(np.uint64)
        for p in _places(hashes):
            np.bitwise_or.at(table, (p, which // 64), np.uint64(1) << (which % 64).astype(np.uint64))
    filled = [((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))]
    return Filters(langs, table, np.array(filled) ** HASHES)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; such documents teach nothing. Null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, sample: int = 4000, profile: int = 3000) -> Filters:
    """Filters of the `profile` n-grams that are in most texts of each language.

    Learns from rows with text, lang and doc_id that are not held out: a bounded sample of about `sample` documents of each
    language, the ones with the lowest hash of their id (all of a smaller language). n-grams are counted once for each text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id")))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    langs = sorted(sizes)
    if not langs:
        return build([], [])
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample / sizes[lang]))])
    index = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    part = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).select(index[F.col("lang")].alias("lang"), "text")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, 1 << 18):
            lang = batch.column(0).to_numpy()
            hashes, text, _ = letter_grams(batch.column(1).to_pylist())
            order = np.lexsort((hashes, text))
            hashes, text = hashes[order], text[order]
            once = np.ones(len(hashes), bool)
            once[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
            hashes, of = hashes[once], lang[text[once]]
            for i in np.unique(of):
                found, n = np.unique(hashes[of == i], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), i, np.int32)), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counts = part.mapInArrow(run, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    def first(rows: DataFrame, *by: Column) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("n"), "gram")
        return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= profile).drop("place")

    # All n-grams of a language are cut down in slices first, so that no task orders all of them.
    best = first(first(counts, F.col("lang"), F.pmod("gram", F.lit(64))), F.col("lang"))
    return build(langs, [(r.lang, r.gram) for r in best.select("lang", "gram").collect()])


def _scored(model: Filters, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(lang_pred, score, known) of each text; see identify."""
    hashes, text, has = letter_grams(texts)
    n = np.bincount(text, minlength=len(texts)).astype(float)
    if not model.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    masks = model.masks(hashes)
    right = np.zeros((len(texts), len(model.langs)))
    for i in range(len(model.langs)):
        bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        hits = np.bincount(text, weights=bit.astype(float), minlength=len(texts))
        right[:, i] = np.maximum(hits - n * model.wrong[i], 0) / (1 - model.wrong[i])  # of hits so many are real
    best = right.argmax(1)
    most, total = right[np.arange(len(best)), best], right.sum(1)
    score = np.where(has & (total > 0), most / np.maximum(total, 1e-9), 0.0)
    known = np.where(has, np.minimum(most / np.maximum(n, 1), 1.0), 0.0)
    return [model.langs[b] if h else UNKNOWN for b, h in zip(best, has)], score, known


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score (0 to 1), known (0 to 1); see identify."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, 1 << 18):
            names, score, known = _scored(shared.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(known)],
                                             names=["doc_id", "held_out", "lang_pred", "score", "known"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, known double")


def least_known(scored: DataFrame, quantile: float = 0.01, margin: float = 0.4) -> dict[str, float]:
    """For each label the share of n-grams that its language must know of a text: a low quantile of the shares known of
    all labelled texts with letters that are not held out, less the margin (a part of it).

    scored: doc_id, lang, lang_pred and known of each row.
    """
    taught = scored.filter(f"doc_id IS NOT NULL AND lang IS NOT NULL AND lang_pred <> '{UNKNOWN}'").filter(~held_out(F.col("doc_id").cast("long")))
    low = taught.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.percentile_approx("known", quantile).alias("low"))
    return {r.lang: r.low * (1 - margin) for r in low.collect()}  # one row for each language


def kept(docs: DataFrame, filters: Filters) -> DataFrame:
    """The rows of docs whose text is in a learned language that knows enough of its n-grams; see least_known.

    Texts are scored once and written with their scores, since the threshold needs the scores of all labelled rows. Null, empty
    and letterless texts go. Where no row teaches a language there is nothing to judge by and all rows stay. Repeated rows
    stay or go together; rows without doc_id are judged like others; other columns are kept, whatever their names; an
    empty table gives no rows.
    """
    if not filters.langs:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    schema = StructType([rows.schema["row"], StructField("lang", StringType()), StructField("known", DoubleType())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, 1 << 18):
            langs, _, known = _scored(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(known)], names=["row", "lang", "known"])

    scored = written(rows.mapInArrow(run, schema), "scored")
    least = least_known(scored.select("row.doc_id", "row.lang", F.col("lang").alias("lang_pred"), "known"))
    if not least:
        return docs
    enough = F.create_map(*[F.lit(x) for lang, share in sorted(least.items()) for x in (lang, share)])
    return scored.filter((F.col("lang") != UNKNOWN) & (F.col("known") >= enough[F.col("lang")])).select("row.*")


def identify(docs: DataFrame, sample: int = 4000, profile: int = 3000) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score, known.

    One bit-sliced Bloom filter holds the n-grams of all languages: a slot has a bit for each language, and the words at
    an n-gram's slots, and-ed, are the languages that hold it. Bits are counted by language over the n-grams of
    the whole text and corrected by the filter's false-positive rate for that language; the largest count decides (ties: the first
    name). score: its share of all corrected counts; known: its share of the text's n-grams. lang_pred is `und`, with
    score 0, for texts that are null, empty or without a letter, and where no language was learned. Repeated rows
    keep their rows; rows without doc_id are predicted but not learned from; an empty table gives no rows.
    """
    return predict(docs, fit(docs, sample, profile))
