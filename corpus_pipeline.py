"""From raw documents to packed sequences: five stages, each one of the operators.

Every stage reads what the one before it wrote. All but the last return the columns of
documents; the last returns the pieces of the packed sequences.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartloom.llm.common import table
from cartloom.llm.mixing import mix_documents
from cartloom.llm.packing import pack_documents
from cartloom.llm.quality import keep_good
from cartloom.llm.simhash import keep_one
from cartloom.llm.toxicity import keep_civil
from cartloom.plans.staging import scratch, staged_folder

STAGES = [
    ("toxicity", keep_civil),
    ("quality rules", keep_good),
    ("simhash near-dedup", keep_one),
    ("mixing sources to target weights", mix_documents),
    ("best-fit packing", pack_documents),
]

#: The first stage is a trained model and the last a heuristic packing: no SQL says them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a directory.

    Each stage's rows are written, and then what it staged on the way is deleted. Nulls,
    empty and very long texts, ties, repeated rows and extra columns are handled as each
    stage says; empty documents give no rows, with the same columns.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{staged_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
