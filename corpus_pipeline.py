"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it kept and returns those it keeps, with the columns
of ``documents``; the last one returns the packed pieces. ``run`` writes every stage as Parquet below
the shared folder and goes on from there, so a lost executor costs no more than the stage at hand.
Further columns of the input, whatever their names, are not carried along.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import decontaminate, lang_id, near_dups, packing, pseudonyms
from labelloom.llm.words import only
from labelloom.shared import work_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A real run takes its key from the caller's secrets; this one only makes the run repeatable.
KEY = "pipeline"
# Words of a shingle of the near-duplicate stage; only the query op10_near_dups takes four.
SHINGLE_WORDS = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter: those whose text is null, empty or holds none go. A text in a language that no label
    knows stays, and so does every text with a letter where no row is labelled. Very long texts are judged whole,
    repeated rows each by itself."""
    docs = only(docs, *COLUMNS)
    model = lang_id.fit(docs)
    return lang_id.recognised(docs, model) if model.languages else docs.where(F.col("text").rlike(r"\p{L}"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one of the smallest id. A document is its id: of its rows each different text stays
    once, with the first of its other columns. Rows without an id, and null and empty texts, are in no group."""
    docs = only(docs, *COLUMNS)
    rows = near_dups.near_duplicates(docs, SHINGLE_WORDS)
    verdicts = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.bool_and("kept").alias("kept"), (F.count("*") > 1).alias("repeated")
    ).where("NOT kept OR repeated")
    # As a table its size is known, so Spark joins it without moving the texts when it is small.
    noted = f"{work_folder(spark)}/verdicts"
    verdicts.write.parquet(noted)
    verdicts = spark.read.schema("doc_id bigint, kept boolean, repeated boolean").parquet(noted)
    single = docs.join(verdicts, "doc_id", "left_anti")
    repeated = docs.join(verdicts.where("kept AND repeated"), "doc_id", "left_semi").groupBy("doc_id", "text").agg(
        F.min(F.struct(*COLUMNS[2:])).alias("row")
    )
    return single.select(*COLUMNS).unionByName(repeated.select("doc_id", "text", "row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; every row is judged by itself, a very long text
    as a whole."""
    return decontaminate.clean(only(docs, *COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal numbers and addresses replaced by pseudonyms; ``n_chars`` follows the text, null for a null one.
    Repeated rows get the same pseudonyms."""
    done = pseudonyms.with_pseudonyms(only(docs, *COLUMNS), KEY)
    return done.withColumn("n_chars", F.length("text").cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of the permitted lengths. A null or empty text is one piece of length 0 in no
    sequence; repeated rows and rows without an id are packed like all others, long texts in several pieces."""
    return packing.pack_documents(docs)


STAGES = [
    ("language identification", language),
    ("near-duplicate removal", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("pseudonyms", pseudonymised),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark)
    for i, (_, stage) in enumerate(STAGES):
        written = f"{folder}/stage-{i + 1}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs


# A learned classifier and a packing search have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None
