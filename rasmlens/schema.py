"""Fixed schemas and column names of the corpus, the stream and its output."""

from pyspark.sql import types as T

# Columns and types of the corpus, the stream and its output.
CORPUS = T.StructType([
    T.StructField("text", T.StringType(), False),
    T.StructField("label", T.IntegerType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
])

STREAM_IN = T.StructType([
    T.StructField("text", T.StringType(), True),
    T.StructField("label", T.IntegerType(), True),
])

STREAM_OUT = T.StructType([
    T.StructField("text", T.StringType(), True),
    T.StructField("label", T.IntegerType(), True),
    T.StructField("prediction", T.DoubleType(), True),
])

# Class numbers and the columns of raw and prepared tables.
HUMAN, AI = 0, 1
CLASSES = (HUMAN, AI)

HUMAN_COLUMN = "original_abstract"
GENERATED_SUFFIX = "_generated_abstract"
AI_COLUMNS = (
    "allam_generated_abstract",
    "jais_generated_abstract",
    "llama_generated_abstract",
    "openai_generated_abstract",
)

CLEAN = "clean_text_columns"
TOKENS = "tokens"
N_TOKENS = "n_tokens"
F023 = "clean_text_columns_f023_avg_syllables_per_word"
F046 = "clean_text_columns_f046_num_nouns"

STORED_COLUMNS = ("text", CLEAN, TOKENS, N_TOKENS, "label", "model", "source")
