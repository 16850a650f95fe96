"""Collocations: the best-scoring phrases of each language, by best-first growth.

Words are counted first, then pairs of frequent words. A pair is a prefix (or, read backwards,
a suffix) that may grow to three words, and its counts bound what can come of it: no
phrase beginning with ``x y`` scores above ``f(x y) / f(x)``, and none ending with it above
``f(x y) / f(y)``. Each round expands the pairs whose bounds reach the language's threshold, best
first, and settles a language once enough surviving phrases score at or above
its threshold: everything above it is then known, ties included. The others lower theirs.

What tasks look up while they read texts are bitmaps over hashes. They never exceed
``MOST_BITS``, and a false positive only counts a phrase that was not needed: a phrase is counted
in all its places or in none, and every result comes from exact counts joined by the words.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasmlens.llm.frames import prepare_workers, stored

#: Bytes that are tokenised at once.
CHUNK = 1 << 20
#: Bits of a bitmap for each of its entries, and at most: 16 MB.
BITS_EACH, MOST_BITS = 32, 1 << 27
#: Pairs expanded in the first round, as a multiple of the wanted phrases, and the growth of
#: that number from round to round.
FIRST_ROUND, GROWTH = 2, 4
#: What a pair can be listed as in a bitmap: frequent, a prefix or a suffix whose bound reaches
#: the threshold, or itself at or above the threshold.
FREQUENT, PREFIX, SUFFIX, SCORING = range(1, 5)
#: What a score of 1 is written as.
UNIT = 1_000_000

_LETTERS = bytes(range(65, 91))
_TABLE = bytes.maketrans(_LETTERS + b".,;:!?\x0a\x0b\x0c\x0d\t", _LETTERS.lower() + b"\n" * 10 + b" ")
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


class Numbers(dict):
    """Numbers words in the order in which they come; the break between pieces has -1."""

    def __init__(self) -> None:
        self[b"\n"] = -1

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) - 1
        return found

    def of(self, text: str) -> Iterator[np.ndarray]:
        """The words of a text, in chunks that end between words."""
        data = text.encode().translate(_TABLE).replace(b"\n", b" \n ")
        start = 0
        while start < len(data):
            end = data.find(b" ", start + CHUNK)
            end = len(data) if end < 0 else end
            chunk = [w for w in data[start:end].split(b" ") if w]
            yield np.fromiter(map(self.__getitem__, chunk), "i4", len(chunk))
            start = end

    def words(self) -> pa.Array:
        return pa.array(list(self)[1:], pa.string())


def by_language(batch: pa.RecordBatch) -> tuple[Numbers, dict[str, np.ndarray]]:
    """The numbered words of all texts of each language; breaks stand between texts."""
    numbers, found = Numbers(), {}
    gap = np.array([-1], "i4")
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
        found.setdefault(lang, []).extend([*numbers.of(text.as_py()), gap])
    return numbers, {lang: np.concatenate(parts) for lang, parts in found.items()}


def hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter(map(xxh64_intdigest, words), "u8", len(words))


def mixed(lang: np.ndarray | np.uint64, first: np.ndarray, second: np.ndarray | None = None, tag: int = 0) -> np.ndarray:
    """One hash of a language, a word or two, and a tag."""
    with np.errstate(over="ignore"):
        h = (lang + np.uint64(tag)) * _ODD[0] ^ first * _ODD[1]
        if second is not None:
            h = (h ^ h >> np.uint64(29)) * _ODD[2] ^ second * _ODD[0]
        h = (h ^ h >> np.uint64(32)) * _ODD[2]
        return h ^ h >> np.uint64(31)


class Bitmap:
    """Membership of hashes, with false positives; sent to tasks."""

    def __init__(self, entries: DataFrame, columns: list[str], tagged: bool) -> None:
        """``entries`` has ``lang``, the named word columns and, where ``tagged``, ``tags``."""
        spark = entries.sparkSession
        bits = 64
        while bits < min(MOST_BITS, BITS_EACH * entries.count()):
            bits *= 2
        self.bits = bits

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lang, *words = [hashes([w.encode() for w in batch.column(c).to_pylist()]) for c in ["lang", *columns]]
                kinds = batch.column("tags").to_pylist() if tagged else [[0]] * batch.num_rows
                rows = np.repeat(np.arange(batch.num_rows), [len(k) for k in kinds])
                tags = np.array([t for k in kinds for t in k], "u8")
                with np.errstate(over="ignore"):
                    h = mixed(lang[rows] + tags, *[w[rows] for w in words]) & np.uint64(bits - 1)
                slot, at = np.unique(h >> np.uint64(6), return_inverse=True)
                mask = np.zeros(len(slot), "u8")
                np.bitwise_or.at(mask, at, np.uint64(1) << (h & np.uint64(63)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot.view("i8")), pa.array(mask.view("i8"))], names=["slot", "mask"])

        found = entries.mapInArrow(places, "slot long, mask long").groupBy("slot").agg(
            F.bit_or("mask").alias("mask")).toArrow()
        words = np.zeros(bits // 64, "u8")
        words[found.column("slot").to_numpy()] = found.column("mask").to_numpy().view("u8")
        self.sent = spark.sparkContext.broadcast(words)

    def has(self, h: np.ndarray) -> np.ndarray:
        h = h & np.uint64(self.bits - 1)
        return self.sent.value[(h >> np.uint64(6)).astype("i8")] >> (h & np.uint64(63)) & np.uint64(1) > 0


def _counted(texts: DataFrame, columns: list[str], count) -> DataFrame:
    """``lang, <columns>, f``: occurrences. ``count(numbers, lang, ids)`` gives the number of each word of
    the phrases of one batch and language, and how often they occur."""
    schema = ", ".join(["lang string", *[f"{c} string" for c in columns], "f long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, of = by_language(batch)
            words = numbers.words()
            for lang, ids in of.items():
                *parts, n = count(numbers, lang, ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), *[words.take(pa.array(p, pa.int64())) for p in parts],
                     pa.array(n, pa.int64())], names=["lang", *columns, "f"])

    return texts.mapInArrow(run, schema).groupBy("lang", *columns).agg(F.sum("f").alias("f"))


def count_words(texts: DataFrame) -> DataFrame:
    def count(numbers: Numbers, lang: str, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        n = np.bincount(ids[ids >= 0])
        found = np.flatnonzero(n)
        return found, n[found]

    return _counted(texts, ["w1"], count)


def _word_hashes(numbers: Numbers, lang: str) -> tuple[np.uint64, np.ndarray]:
    """Of the language and of all words of the batch, which are hashed once."""
    if not hasattr(numbers, "hashed"):
        numbers.hashed = hashes(list(numbers)[1:])
    return hashes([lang.encode()])[0], numbers.hashed


def _frequent(numbers: Numbers, lang: str, ids: np.ndarray, known: Bitmap) -> np.ndarray:
    """``ids`` with -1 in the place of words that are not frequent."""
    code, words = _word_hashes(numbers, lang)
    listed = np.append(known.has(mixed(code, words)), False)
    return np.where(listed[ids], ids, -1)


def count_pairs(texts: DataFrame, known: Bitmap) -> DataFrame:
    def count(numbers: Numbers, lang: str, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        ids = _frequent(numbers, lang, ids, known).astype("i8")
        both = (ids[:-1] >= 0) & (ids[1:] >= 0)
        size = len(numbers)
        pairs, n = np.unique(ids[:-1][both] * size + ids[1:][both], return_counts=True)
        return pairs // size, pairs % size, n

    return _counted(texts, ["w1", "w2"], count)


def count_triples(texts: DataFrame, known: Bitmap, listed: Bitmap, done: list[Bitmap]) -> DataFrame:
    """Triples that the bitmap of pairs ``listed`` calls for and that none of ``done`` did."""
    def count(numbers: Numbers, lang: str, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        code, words = _word_hashes(numbers, lang)
        ids = _frequent(numbers, lang, ids, known).astype("i8")
        size = len(numbers)
        at = np.flatnonzero((ids[:-2] >= 0) & (ids[1:-1] >= 0) & (ids[2:] >= 0)) if len(ids) > 2 else np.zeros(0, "i8")
        # Pairs are looked up once each, however often they occur.
        pairs, back = np.unique(np.concatenate([ids[at] * size + ids[at + 1], ids[at + 1] * size + ids[at + 2]]),
                                return_inverse=True)
        first, second = words[pairs // size], words[pairs % size]
        left, right = back[:len(at)], back[len(at):]

        def wanted(bitmap: Bitmap) -> np.ndarray:
            is_ = {tag: bitmap.has(mixed(code, first, second, tag)) for tag in (FREQUENT, PREFIX, SUFFIX, SCORING)}
            call = is_[PREFIX][left] & is_[SUFFIX][right] | is_[SCORING][left] | is_[SCORING][right]
            return call & is_[FREQUENT][left] & is_[FREQUENT][right]

        chosen = wanted(listed)
        for earlier in done:
            chosen &= ~wanted(earlier)
        triples, n = np.unique(left[chosen] * size + ids[at[chosen] + 2], return_counts=True)
        pair = pairs[triples // size]
        return pair // size, pair % size, triples % size, n

    return _counted(texts, ["w1", "w2", "w3"], count)


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """``floor(UNIT * a * a / (l * r))``, exact for counts below 10 ** 15."""
    a, l, r = [c.cast("decimal(15,0)") for c in (a, l, r)]  # noqa: E741
    return F.call_function("div", F.lit(UNIT).cast("decimal(7,0)") * (a * a), l * r)


def scored_pairs(counted: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, w1, w2, a, l, r, score`` and the bounds ``as_prefix`` and ``as_suffix`` of what grows from a pair."""
    first = words.select("lang", "w1", F.col("f").alias("l"))
    second = words.select("lang", F.col("w1").alias("w2"), F.col("f").alias("r"))
    bound = lambda whole: F.call_function(
        "div", F.lit(UNIT).cast("decimal(7,0)") * F.col("a").cast("decimal(15,0)"), F.col(whole).cast("decimal(15,0)"))
    return (counted.withColumnRenamed("f", "a").join(first, ["lang", "w1"]).join(second, ["lang", "w2"])
            .withColumns({"score": score(F.col("a"), F.col("l"), F.col("r")),
                          "as_prefix": bound("l"), "as_suffix": bound("r")}))


def scored_triples(counted: DataFrame, pairs: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, a, l, r, score`` by the lowest-scoring cut, the first one in ties."""
    first = pairs.select("lang", "w1", "w2", F.col("l").alias("l1"), F.col("a").alias("l2"))
    second = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    both = counted.withColumnRenamed("f", "a").join(first, ["lang", "w1", "w2"]).join(second, ["lang", "w2", "w3"])
    cut = lambda k: F.struct(
        score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
        F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
    return both.select("lang", "w1", "w2", "w3", "a", F.least(cut(1), cut(2)).alias("cut")).select(
        "lang", "w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")


def surviving(pairs: DataFrame, triples: DataFrame, thresholds: DataFrame, contained_percent: int) -> DataFrame:
    """``lang, phrase, a, l, r, score``: what scores at or above its language's threshold and is not
    contained in a longer candidate that is frequent enough."""
    inside = triples.select("lang", "w1", "w2", "a").unionByName(
        triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longest = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    least = thresholds.select("lang", "threshold")
    alone = (pairs.join(least, "lang").where("score >= threshold").join(longest, ["lang", "w1", "w2"], "left")
             .where(F.col("longer").isNull() | (100 * F.col("longer") < contained_percent * F.col("a"))))
    grown = triples.join(least, "lang").where("score >= threshold")
    return alone.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score").unionByName(
        grown.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score"))


def threshold_at(pairs: DataFrame, size: int) -> DataFrame:
    """``lang, threshold``: the score that ``size`` pairs of the language reach; 0 if there are fewer."""
    by_score = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    down = Window.partitionBy("lang").orderBy(F.col("score").desc())
    reached = by_score.withColumn("reached", F.sum("n").over(down))
    return reached.groupBy("lang").agg(F.coalesce(
        F.max(F.when(F.col("reached") >= size, F.col("score"))), F.lit(0)).cast("long").alias("threshold"))


def collocations(
    docs: DataFrame, per_language: int = 2000, min_count: int = 10, contained_percent: int = 50,
    lang: str = "lang", text: str = "text", unknown: str = "und",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``per_language`` best phrases of each language.

    Phrases have two or three words, stand within a piece of text between punctuation marks or line
    ends, and occur at least ``min_count`` times in the language. ``a``, ``l`` and ``r`` are the
    occurrences of the phrase and of the two parts into which its lowest-scoring cut parts it, ``n`` those of all words,
    ``score`` is ``floor(10**6 * a * a / (l * r))``. A pair is left out if a phrase around it has
    at least ``contained_percent`` of its occurrences. Order: score and ``a`` descending, then the phrase.

    A null language is ``unknown``, a null or empty text has no words; repeated rows count
    each time; other columns are not looked at; an empty table gives no rows. Every count covers all
    texts; a very long text is tokenised in chunks and counted whole. Each round reads the texts
    once; rounds end at the latest when all pairs are expanded.
    """
    prepare_workers(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(unknown)).alias("lang"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = stored(count_words(texts), "words")
    words = counted.where(F.col("f") >= min_count)
    known = Bitmap(words, ["w1"], tagged=False)
    frequent = stored(count_pairs(texts, known).where(F.col("f") >= min_count), "counted_pairs")
    pairs = stored(scored_pairs(frequent, words), "pairs")

    thresholds, triples, done, size = None, None, [], FIRST_ROUND * per_language
    while True:
        aims = threshold_at(pairs, size)
        if thresholds is not None:
            settled = thresholds.where("settled").select("lang", F.col("threshold").alias("had"), "settled")
            aims = aims.join(settled, "lang", "left").select(
                "lang", F.coalesce("had", "threshold").alias("threshold"), F.coalesce("settled", F.lit(False)).alias("settled"))
        else:
            aims = aims.withColumn("settled", F.lit(False))
        aims = stored(aims, "aims")
        reach = lambda c: F.col(c) >= F.col("threshold")
        frontier = pairs.join(aims.where(~F.col("settled")), "lang").select("lang", "w1", "w2", F.array_compact(F.array(
            F.lit(FREQUENT), F.when(reach("as_prefix"), F.lit(PREFIX)), F.when(reach("as_suffix"), F.lit(SUFFIX)),
            F.when(reach("score"), F.lit(SCORING)))).alias("tags"))
        listed = Bitmap(frontier, ["w1", "w2"], tagged=True)
        found = stored(scored_triples(
            count_triples(texts, known, listed, done).where(F.col("f") >= min_count), pairs), "triples")
        triples = found if triples is None else triples.unionByName(found)
        done = [*done, listed]
        reached = surviving(pairs, triples, aims, contained_percent).groupBy("lang").agg(F.count("*").alias("n"))
        enough = (F.col("threshold") == 0) | (F.coalesce("n", F.lit(0)) >= per_language)
        thresholds = stored(aims.join(reached, "lang", "left").select(
            "lang", "threshold", (F.col("settled") | enough).alias("settled")), "thresholds")
        if thresholds.where(~F.col("settled")).isEmpty():
            break
        size *= GROWTH

    total = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = surviving(pairs, triples, thresholds, contained_percent).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= per_language)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
