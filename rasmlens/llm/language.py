"""Language identification by a mixture of languages per document.

Languages are distributions over letter trigrams. A document is a mixture of them whose
proportions are estimated by expectation maximisation; how many languages it is made of
is decided by likelihood with a penalty for every further language.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasmlens.llm.frames import prepare_workers

UNDETERMINED = "und"
#: Trigrams are hashed to so many bins.
BINS = 1 << 14
#: Characters that are worked on together, unless one text alone has more.
CHUNK_CHARS = 200_000
MAX_DOCS = 64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigram_bins(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every letter of every text: the text's place, and the bin of the trigram around
    the letter. Whatever is no letter counts as a space."""
    lower = [t.lower() for t in texts]
    joined = "\n" + "\n".join(lower) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in lower])
    is_letter = _letters()[codes]
    codes = np.where(is_letter, codes, 0).astype("u4")
    at = np.flatnonzero(is_letter)
    with np.errstate(over="ignore"):
        mixed = (codes[at - 1] * np.uint32(0x9E3779B1) ^ codes[at] * np.uint32(0x85EBCA77)
                 ^ codes[at + 1] * np.uint32(0xC2B2AE3D))
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
    return np.searchsorted(ends, at, side="left"), (mixed >> np.uint32(18)).astype("i8")


def blocks(texts: list[str]) -> Iterator[range]:
    """Consecutive places of texts that are worked on together."""
    first, chars = 0, 0
    for i, text in enumerate(texts):
        if i > first and (chars + len(text) > CHUNK_CHARS or i - first == MAX_DOCS):
            yield range(first, i)
            first, chars = i, 0
        chars += len(text)
    if first < len(texts):
        yield range(first, len(texts))


@dataclass(frozen=True)
class LanguageModel:
    """Trigram probabilities, one row per language."""

    languages: tuple[str, ...]
    probabilities: np.ndarray


def train(
    docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id",
    max_rows_per_language: int = 20_000, smoothing: float = 0.5,
) -> LanguageModel:
    """Trigram distributions of the labelled documents; rows without text or language don't count.

    Fitted on at most about ``max_rows_per_language`` documents of each language, chosen by
    a hash of ``key``. The model has one row of ``BINS`` numbers per language, which is also
    all that reaches the driver.
    """
    prepare_workers(docs.sparkSession)
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    rate = (docs.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("_lang"))
            .agg((max_rows_per_language / F.count("*")).alias("rate")))
    place = F.shiftrightunsigned(F.xxhash64("key"), 11) / float(1 << 53)
    # One row per language, as the model has; so texts need not be dealt out by language.
    chosen = labelled.join(F.broadcast(rate), F.col("lang") == F.col("_lang")).where(
        place < F.col("rate")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for part in blocks(texts):
                place, bins = trigram_bins([texts[i] for i in part])
                for name in {langs[i] for i in part}:
                    mine = np.array([langs[i] == name for i in part])
                    sums.setdefault(name, np.zeros(BINS, "i8"))
                    sums[name] += np.bincount(bins[mine[place]], minlength=BINS)
        for name, total in sums.items():
            full = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(full), pa.string()), pa.array(full.astype("i4")), pa.array(total[full])],
                names=["lang", "bin", "n"])

    counted = (chosen.mapInArrow(count, "lang string, bin int, n long")
               .groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect())
    languages = tuple(sorted({row["lang"] for row in counted}))
    table = np.full((len(languages), BINS), smoothing)
    for row in counted:
        table[languages.index(row["lang"]), row["bin"]] += row["n"]
    return LanguageModel(languages, table / table.sum(axis=1, keepdims=True))


@dataclass
class _Counts:
    """Trigram counts of several documents: entry i is ``n[i]`` times a trigram of ``doc[i]``
    with the probabilities ``p[:, i]``."""

    doc: np.ndarray
    n: np.ndarray
    p: np.ndarray
    docs: int

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, values, self.docs)

    def only(self, chosen: np.ndarray) -> "_Counts":
        """The documents where ``chosen``, numbered anew."""
        number = np.cumsum(chosen) - 1
        entry = chosen[self.doc]
        return _Counts(number[self.doc[entry]], self.n[entry], self.p[:, entry], int(chosen.sum()))


def mixture(counts: _Counts, start: np.ndarray, rounds: int, tolerance: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) after EM from ``start``, and log-likelihoods.

    A language with proportion 0 at the start keeps it.
    """
    share = start.copy()
    total = counts.per_doc(counts.n)
    used = np.flatnonzero(share.any(axis=0))
    for _ in range(rounds):
        weight = np.stack([share[counts.doc, k] * counts.p[k] for k in used])
        weight *= counts.n / weight.sum(axis=0)
        new = np.zeros_like(share)
        for k, w in zip(used, weight):
            new[:, k] = counts.per_doc(w)
        new /= total[:, None]
        moved = np.abs(new - share).max(initial=0.0)
        share = new
        if moved < tolerance:
            break
    mixed = sum(share[counts.doc, k] * counts.p[k] for k in used)
    return share, counts.per_doc(counts.n * np.log(mixed))


def infer(counts: _Counts, penalty: float, rounds: int) -> np.ndarray:
    """Proportions of the language set with the best penalised likelihood.

    Languages enter by their proportion in the mixture of all languages, one at a time,
    for as long as the likelihood gains more than the penalty. Overlapping trigrams tell
    the same letter three times, so a third of the log-likelihood counts.
    """
    languages = len(counts.p)
    everything = np.full((counts.docs, languages), 1.0 / languages)
    ranked = np.argsort(-mixture(counts, everything, rounds)[0], axis=1, kind="stable")
    best = np.zeros((counts.docs, languages))
    best[np.arange(counts.docs), ranked[:, 0]] = 1.0
    likelihood = mixture(counts, best, 0)[1]
    open_docs = np.arange(counts.docs)
    letters = counts.per_doc(counts.n)
    for size in range(2, languages + 1):
        here = counts.only(np.isin(np.arange(counts.docs), open_docs))
        start = np.zeros((len(open_docs), languages))
        np.put_along_axis(start, ranked[open_docs, :size], 1.0 / size, axis=1)
        share, now = mixture(here, start, rounds)
        better = (now - likelihood[open_docs]) / 3 > penalty * np.log(letters[open_docs])
        open_docs, share, now = open_docs[better], share[better], now[better]
        if not len(open_docs):
            break
        best[open_docs], likelihood[open_docs] = share, now
    return best


def predict(texts: list[str | None], model: LanguageModel, penalty: float, rounds: int) -> tuple[list, list, list]:
    """Per text: language, its proportion, and the proportions of all languages it holds."""
    name, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    shares: list[list] = [[] for _ in texts]
    known = [t or "" for t in texts]
    for part in blocks(known) if model.languages else ():
        place, bins = trigram_bins([known[i] for i in part])
        cells = np.bincount(place * BINS + bins, minlength=len(part) * BINS)
        full = np.flatnonzero(cells)
        counts = _Counts(full // BINS, cells[full].astype("f8"), model.probabilities[:, full % BINS], len(part))
        some = np.bincount(counts.doc, minlength=len(part)) > 0
        if not some.any():
            continue
        found = infer(counts.only(some), penalty, rounds)
        for i, row in zip(np.flatnonzero(some).tolist(), found):
            at, best = part[i], int(row.argmax())
            name[at], score[at] = model.languages[best], min(1.0, float(row[best]))
            shares[at] = [{"lang": model.languages[k], "share": float(row[k])} for k in np.flatnonzero(row)]
    return name, score, shares


def identify(
    docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text",
    penalty: float = 1.0, rounds: int = 12,
) -> DataFrame:
    """Columns ``keep`` with ``lang_pred``, ``score`` and ``languages`` (lang, share).

    ``lang_pred`` has the largest proportion, ``score`` is that proportion; equal proportions
    go to the first name. A null text, one without a letter, and any text under a model
    without languages is ``und`` with score 0. Nothing but the text is looked at; equal rows
    get equal results; an empty table gives no rows. Of ``keep``, columns named like the
    added ones are dropped. One pass without a shuffle.
    """
    prepare_workers(docs.sparkSession)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    added = T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("languages", T.ArrayType(T.StructType([
            T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])))])
    keep = [c for c in keep if c not in added.names]
    chosen = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("text"))
    out = T.StructType([chosen.schema["row"], *added.fields])
    shares_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, score, shares = predict(batch.column("text").to_pylist(), sent.value, penalty, rounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(name, pa.string()), pa.array(score, pa.float64()),
                 pa.array(shares, shares_type)], names=out.names)

    return chosen.mapInArrow(run, out).select("row.*", *added.names)


def held_out(id: Column) -> Column:
    """True where the CRC-32 of the id as text leaves 1 by 3; false for a null id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
