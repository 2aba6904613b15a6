"""Labelled picture folders."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import percent_decode

PICTURES = "*.{png,jpg,jpeg,gif,bmp,PNG,JPG,JPEG,GIF,BMP}"


def read_labelled_images(spark: SparkSession, root: str, pattern: str = PICTURES) -> DataFrame:
    """Pictures below ``root/<class>/``: columns ``image``, ``class_name`` and ``reason``.

    Files are chosen by the ``pattern`` of their name. The class is the first folder below ``root``; deeper
    folders belong to it. ``reason`` is NULL for a good row; an unreadable picture
    and one that lies in no class folder are kept, with the reason.
    """
    pictures = (
        spark.read.format("image")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("dropInvalid", False)
        .load(root)
    )
    # The root is cut off as a prefix, so a class may bear its name.
    folder = F.lit("/" + root.split(":", 1)[-1].strip("/") + "/")
    origin = percent_decode(F.col("image.origin"))
    below = F.substr(origin, F.instr(origin, folder) + F.length(folder))
    class_name = F.when(F.instr(below, F.lit("/")) > 0, F.substring_index(below, "/", 1))
    unreadable = F.coalesce(F.col("image.height") <= 0, F.lit(True))
    return pictures.withColumn("class_name", class_name).withColumn(
        "reason",
        F.when(unreadable, "unreadable").when(F.col("class_name").isNull(), "no class folder"),
    )
