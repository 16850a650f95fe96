"""The driver's tables as the inputs that the analytics expect.

The documents hold no Arabic, so ``to_arabic`` rewrites their letters with a fixed
synthetic alphabet. It is one-to-one and chosen so that frequent words turn into
stop-words, verbs, and words with the listed prefix and suffixes, and so that
capitals and signs turn into the hamza, alef, ligature and diacritic forms that
cleaning has to handle.
"""

from collections.abc import Callable
from typing import TypeVar
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasmlens import schema, workspace
from rasmlens.operators import list_tokens, prepare, split_index
from rasmlens.operators.arena import ModelArena, default_estimators
from rasmlens.operators.features import fit_features, vectorize
from rasmlens.sources import spread

# The synthetic alphabet, position by position.
LATIN = "abcdefghijklmnopqrstuvwxyz" "ABCDEFGHIN" "|*#$"
ARABIC = "ابسفيجغهعضشلحنوطذرمتكدقصةز" "أ\uFEF7آءإئٱؤ\uFEFBى" "\u064E\u0640\u0652\u064B"

#: Rows in one file of stored vectors. Spark reads at most 32 small files in one task (128 MB with 4 MB
#: charged for opening each), and a forest's fit holds some 16 KB for each row of a task.
VECTOR_FILE_ROWS = 1000

T = TypeVar("T")
_made: WeakKeyDictionary = WeakKeyDictionary()


def _state(spark: SparkSession, sf_dir: str) -> str:
    """Changes when a file of the tables does that the stored results come from. Comes from a listing
    of the files; nothing is read."""
    return str([workspace.listing(spark, f"{sf_dir}/{name}.parquet") for name in ("documents", "labels")])


def stands(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether ``once`` has kept this and its input files have stayed as they were."""
    kept = _made.get(spark, {}).get((sf_dir, name))
    return kept is not None and kept[0] == _state(spark, sf_dir)


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], T]) -> T:
    """Keep a written table or a fitted model for the other queries of the session, for as
    long as the input files stay as they are."""
    kept = _made.setdefault(spark, {})
    key = (sf_dir, name)
    state = _state(spark, sf_dir)
    if key not in kept or kept[key][0] != state:
        kept[key] = (state, make())
    return kept[key][1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def to_arabic(text: Column) -> Column:
    return F.translate(text, LATIN, ARABIC)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, text, lang, source."""
    return _arabic(spread(table(spark, sf_dir, "documents")))


def _arabic(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select("doc_id", to_arabic(F.col("text")).alias("text"), "lang", "source", *keep)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, text, label (null where there is none), model, source.

    The join comes before any text work. ``doc_id`` is unique on both sides, so no key can
    be hot; the join is broadcast only where Spark finds the labels small.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = spread(table(spark, sf_dir, "documents")).join(labels, "doc_id", "left")
    return _arabic(rows, "label").select(
        "doc_id", "text", "label", F.col("lang").alias("model"), "source")


def labelled(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("label").isNotNull())


def wide_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn, with its text in the column of its role. A system turn is neither
    human nor generated, so both columns are null."""
    def said_by(role: str) -> Column:
        return F.when(F.col("role") == role, to_arabic(F.col("text")))

    return table(spark, sf_dir, "conversations").select(
        "conv_id", said_by("user").alias(schema.HUMAN_COLUMN),
        said_by("assistant").alias("openai_generated_abstract"))


def wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with the text in the column of its label."""
    text, label = F.col("text"), F.col("label")
    return labelled(corpus(spark, sf_dir)).select(
        "doc_id",
        F.when(label == schema.HUMAN, text).alias(schema.HUMAN_COLUMN),
        F.when(label == schema.AI, text).alias("jais_generated_abstract"))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus, cleaned and with features, as a stored table without the texts.

    Written once per session: every later query reads only the columns it needs, and
    the text rules are not evaluated again.
    """
    def write() -> str:
        path = workspace.fresh_dir(spark, "prepared")
        prepare(corpus(spark, sf_dir)).drop("text", schema.CLEAN).write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "prepared", write))


def prepared_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled rows of ``prepared``. Where the session has not stored that, the other rows are not
    prepared for it."""
    if stands(spark, sf_dir, "prepared"):
        return labelled(prepared(spark, sf_dir))

    def write() -> str:
        path = workspace.fresh_dir(spark, "prepared_labelled")
        prepare(labelled(corpus(spark, sf_dir))).drop("text", schema.CLEAN).write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "prepared_labelled", write))


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as (doc_id, tokens), stop-words included, as a stored table."""
    def write() -> str:
        path = workspace.fresh_dir(spark, "tokenized")
        list_tokens(documents(spark, sf_dir)).select("doc_id", schema.TOKENS).write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "tokenized", write))


class Lab:
    """Features fitted on all documents, and splits and classifiers of the labelled ones.

    The labelled feature vectors are stored once, one folder per split, so the passes of every
    fit and evaluation read only their own rows and build nothing again. Files hold few rows, so
    the rows of a task do not grow with the table. A lost executor costs only the partitions
    it was reading.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        rows = prepared(spark, sf_dir)
        self.features = fit_features(rows)
        path = workspace.fresh_dir(spark, "vectors")
        vectors = vectorize(self.features, labelled(rows), keep=("doc_id",))
        (vectors.withColumn("split", split_index("doc_id")).write
         .option("maxRecordsPerFile", VECTOR_FILE_ROWS).partitionBy("split").parquet(path))
        self.vectors = spark.read.parquet(path)
        self.train, self.validation, self.test = (
            self.vectors.where(F.col("split") == i) for i in range(3))
        self.arena = ModelArena(self.train, self.validation)

    def fit(self, *names: str) -> ModelArena:
        """The arena with at least the named classifiers (all by default) fitted."""
        estimators = default_estimators()
        missing = [n for n in names or estimators if n not in self.arena]
        self.arena.add_all({n: estimators[n] for n in missing}, parallelism=max(1, len(missing)))
        return self.arena


def lab(spark: SparkSession, sf_dir: str) -> Lab:
    return once(spark, sf_dir, "lab", lambda: Lab(spark, sf_dir))
