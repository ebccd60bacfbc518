"""From raw documents to training ids: five stages, each on all that the one before kept.

Every stage's rows are written as Parquet to the shared folder and read again.
A stage decides by row: null and repeated ids are rows like any other, columns
beyond those of documents are carried along by all but the last, and an empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebasket.llm import cube, neardup, pii, quality, viterbi
from rebasket.session import stored

PIECES = "piece_bpe_32k.model"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level classifier rejects go.

    A null text is scored as an empty one; repeated rows are kept or go alike. Without
    labels of both kinds, all documents share one answer.
    """
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the least id stays.

    Of repeated rows one stays, a null id comes after all others, and rows without
    words (null, empty, blank) all stay.
    """
    return neardup.deduplicated(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind.

    No row goes. A null text stays null, an empty one empty; equal texts change alike.
    """
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay, go or repeat so that the sources' words meet their targets.

    A null source is a source of its own, named last; a text without words (null,
    empty) counts none and is taken as often as others of its source.
    """
    return cube.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, with its id, language, source and length.

    A null or empty text has no ids; repeated rows are encoded one by one.
    """
    import public_tokenizers

    return viterbi.encode_texts(docs, public_tokenizers.path(PIECES), ["doc_id", "lang", "source", "n_chars"])


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]

#: The classifier, the flight of the cube and the ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
