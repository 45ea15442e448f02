"""Take in new candidate texts: check each, and find those that were taken before.

The input is a folder to which Parquet files are added.  A file stream
with a checkpoint takes only the files that no earlier run has taken; each
micro-batch is written to its own folder ``batch=N``, partitioned by status,
and overwritten if it is replayed, so a run that died and is started again
gives the same rows once.

A text's status is the first that holds:

duplicate  it was taken in an earlier batch, or another row of this batch has it with a smaller doc_id; ``first_id`` is that one
blocked    ``n_chars`` isn't its length, or the length is out of bounds
flagged    the liability scan (upper-case letters) finds something, listed in ``flags``
clean      none of these

A null text is an empty one and a null id comes after all others.  Contents
are compared by SHA-256.  Rows alike in id and text are one candidate that
came twice: all but one are duplicates.

    python -m jobs.intake_texts --input DIR --output DIR --checkpoint DIR [--config FILE]
"""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions import sequences
from sievework.plans.shared import materialize, temporary
from sievework.session import get_session

log = logging.getLogger("jobs.intake_texts")
CONFIG = Path(__file__).with_suffix(".yaml")
INPUT = "doc_id long, text string, lang string, source string, n_chars long"
OUTPUT = "doc_id long, source string, content string, n_chars long, length long, flags string, first_id long, batch long, status string"
#: Upper-case letters by ASCII only: upper() makes two letters of some.
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def load_config(path: str | Path = CONFIG) -> dict:
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def checked(texts: DataFrame, config: dict) -> DataFrame:
    """The texts' contents, lengths, flags and own status; texts themselves aren't kept."""
    text = F.coalesce("text", F.lit(""))
    low, high = config["length"]
    rows = texts.select("doc_id", "source", "n_chars", text.alias("text"))
    flags = F.array_join(sequences.liability_flags(F.translate("text", _LOWER, _UPPER), config), ",")
    rows = rows.select("doc_id", "source", F.sha2("text", 256).alias("content"), "n_chars", F.length("text").cast("long").alias("length"), sequences.length_within(F.col("text"), low, high).alias("_fits"), flags.alias("flags"))
    blocked = ~F.col("n_chars").eqNullSafe(F.col("length")) | ~F.col("_fits")
    return rows.withColumn("status", F.when(blocked, "blocked").when(F.col("flags") != "", "flagged").otherwise("clean")).drop("_fits")


def judged(rows: DataFrame, before: DataFrame) -> DataFrame:
    """Rows with ``duplicate`` and ``first_id`` where the content was taken ``before`` (content, first_id) or is repeated.

    Of each content one row stays.  Contents are counted before they are
    joined; rows are joined only to the contents that are repeated or known,
    by adaptive execution in parts where one content has very many rows.
    """
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(rows, "intake-rows")  # row numbers must not change when a task is run again
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_row")
    contents = rows.groupBy("content").agg(F.min(place).alias("head"), F.count("*").alias("n"))
    known = contents.join(before, "content", "left").where("n > 1 or known")
    known = known.select("content", F.coalesce("known", F.lit(False)).alias("known"), F.when(F.col("known"), F.col("first_id")).otherwise(F.col("head.doc_id")).alias("first_id"), F.col("head._row").alias("head"))
    joined = rows.join(known, "content", "left")
    again = F.coalesce(F.col("known") | (F.col("_row") != F.col("head")), F.lit(False))
    return joined.select("doc_id", "source", "content", "n_chars", "length", "flags", F.when(again, F.col("first_id")).alias("first_id"), F.when(again, "duplicate").otherwise(F.col("status")).alias("status"))


def read_output(spark: SparkSession, output: str) -> DataFrame:
    """All batches written so far; an empty table before the first."""
    try:
        return spark.read.schema(OUTPUT).parquet(output)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], OUTPUT)


def run(spark: SparkSession, source: str, output: str, checkpoint: str, config: dict) -> DataFrame:
    """Take what is new in ``source``, wait for the end, and return the whole output read back."""
    output = output.rstrip("/")
    reader = spark.readStream.schema(INPUT)
    if config.get("files_per_batch"):
        reader = reader.option("maxFilesPerTrigger", int(config["files_per_batch"]))

    def take(texts: DataFrame, number: int) -> None:
        earlier = read_output(texts.sparkSession, output).where((F.col("batch") < number) & (F.col("status") != "duplicate"))
        before = earlier.groupBy("content").agg(F.min("doc_id").alias("first_id")).withColumn("known", F.lit(True))
        with temporary(texts.sparkSession):
            judged(checked(texts, config), before).write.mode("overwrite").partitionBy("status").parquet(f"{output}/batch={number}")
        for row in read_output(texts.sparkSession, output).where(F.col("batch") == number).groupBy("status").count().orderBy("status").collect():  # four rows at most
            log.info("batch %d of %s: %d %s", number, source, row["count"], row["status"])

    log.info("taking what is new in %s; checkpoint %s", source, checkpoint)
    stream = reader.parquet(source).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    written = read_output(spark, output)
    log.info("%s holds %d rows", output, written.count())
    return written


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobs.intake_texts", description=__doc__)
    parser.add_argument("--input", required=True, help="folder of Parquet files of texts, or a pattern")
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--config", default=str(CONFIG))
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = get_session("intake-texts")
    try:
        run(spark, args.input, args.output, args.checkpoint, load_config(args.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
