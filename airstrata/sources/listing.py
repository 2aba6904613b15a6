"""File lists, and what changed in a folder since it was last looked at."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import media_type
from ..workspace import workspace

LISTING = "path string, length long, modificationTime timestamp, media_type string"
ADDED, CHANGED, GONE, SAME = "added", "changed", "gone", "same"


def list_files(spark: SparkSession, root: str, suffix: str | None = None) -> DataFrame:
    """Path, size, change time and content type of every file below ``root``.

    The bytes of the files are never read: the unselected ``content`` column is
    pruned. Empty files, such as folder markers, are not listed.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
        .withColumn("media_type", media_type(F.col("path")))
    )
    return files if suffix is None else files.where(F.col("path").endswith(suffix))


def has_files(spark: SparkSession, root: str, suffix: str | None = None) -> bool:
    """Whether ``root`` exists and holds at least one (matching) file."""
    try:
        return not list_files(spark, root, suffix).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def compare_listings(now: DataFrame, before: DataFrame) -> DataFrame:
    """The files of two listings by path, with ``change``: added, changed (another size or time), gone or same.

    Size and time are those of the later listing, or of the earlier one for a file that is gone.
    """
    own, old = [df.select("path", F.struct("length", "modificationTime", "media_type").alias(n)) for df, n in ((now, "own"), (before, "old"))]
    alike = (F.col("own.length") == F.col("old.length")) & (F.col("own.modificationTime") == F.col("old.modificationTime"))
    change = (
        F.when(F.col("old").isNull(), ADDED).when(F.col("own").isNull(), GONE).when(alike, SAME).otherwise(CHANGED)
    )
    both = own.join(old, "path", "full_outer").withColumn("change", change)
    return both.select("path", F.coalesce("own", "old").alias("file"), "change").select("path", "file.*", "change")


def _last_listing(spark: SparkSession, state: str) -> tuple[DataFrame, int]:
    """The listing that was accepted last, and its number (0: there is none)."""
    try:
        known = spark.read.schema(f"{LISTING}, number int").parquet(state)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING), 0
    last = known.agg(F.max("number")).first()[0]
    return known.where(F.col("number") == last).drop("number"), last or 0


class Landing:
    """A folder against the listing stored at ``state``, as of when this is made.

    ``changes`` lists all files with what became of them. Once what is new has been dealt with,
    ``accept`` stores the listing, so a run that fails before meets the same changes again.
    """

    def __init__(self, spark: SparkSession, root: str, state: str, suffix: str | None = None):
        before, self.number = _last_listing(spark, state)
        path = workspace(spark, "changes")
        compare_listings(list_files(spark, root, suffix), before).write.parquet(path)
        self.changes = spark.read.schema(f"{LISTING}, change string").parquet(path)
        self.state = state

    def fresh(self) -> list[str]:
        """The paths that were added or changed; one per file of the run comes to the driver."""
        some = self.changes.where(F.col("change").isin(ADDED, CHANGED)).select("path").collect()
        return sorted(row["path"] for row in some)

    def accept(self) -> None:
        listing = self.changes.where(F.col("change") != GONE).drop("change")
        listing.hint("rebalance").write.mode("overwrite").parquet(f"{self.state}/number={self.number + 1}")
