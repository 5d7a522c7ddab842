"""Release archives named on a page, and the catalogue of files on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Words of a release archive's name.
KEYWORDS = "human_rx|human_otc|homeopathic|animal|remainder|full_release"


def absolute(href: Column, base: Column) -> Column:
    """The link's address: absolute ones stay, root-relative ones get the base's host, others its folder."""
    host = F.regexp_extract(base, r"^(https?://[^/]+)", 1)
    folder = F.regexp_replace(base, r"[^/]*$", "")
    return F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("/"), F.concat(host, href)).otherwise(F.concat(folder, href))


def release_links(pages: DataFrame, html: str = "html", base: str = "url", keywords: str = KEYWORDS) -> DataFrame:
    """url, filename, position of the archives a page links to, first occurrence of each name, in order.

    Links stand in the part headed Full Releases where there is one, else anywhere on the page.
    Pages without links give no row.
    """
    part = F.regexp_extract(F.col(html), r"(?is)<h3[^>]*>[^<]*Full Releases.*?(?=<h3|\z)", 0)
    hrefs = lambda c: F.regexp_extract_all(c, F.lit(r'(?i)<a\b[^>]*?href="([^"]+\.zip)"'), F.lit(1))
    found = F.when(F.size(hrefs(part)) > 0, hrefs(part)).otherwise(hrefs(F.col(html)))
    rows = pages.select(F.col(base).alias("base"), F.posexplode(found).alias("position", "href"))
    url = absolute(F.col("href"), F.col("base"))
    rows = rows.select("base", "position", url.alias("url"), F.element_at(F.split(F.parse_url(url, F.lit("PATH")), "/"), -1).alias("filename"))
    rows = rows.where(F.lower("filename").rlike(keywords))
    w = Window.partitionBy("base", "filename").orderBy("position")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def file_catalog(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """local_path, filename, file_size, modified, md5_hash of the files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path").alias("local_path"), F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified"), F.md5("content").alias("md5_hash"),
    )


#: Columns of the download log.
TRACKED = "filename string, url string, local_path string, file_size long, md5_hash string, download_time timestamp"


def read_tracker(spark: SparkSession, path: str) -> DataFrame:
    """The log of tracked files, one JSON object of objects by file name per file of ``path``; a corrupt log holds no entry."""
    raw = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", f"map<string,struct<{', '.join(x.replace(' ', ':', 1) for x in TRACKED.split(', ')[1:])}>>")
    rows = raw.where(F.expr("try_parse_json(value) IS NOT NULL")).select(F.explode_outer(entries).alias("filename", "f")).where("filename is not null")
    return rows.select("filename", "f.*")


def write_tracker(entries: DataFrame, path: str) -> None:
    """Writes the log in the form that :func:`read_tracker` reads, one object per task."""
    columns = [c.split(" ")[0] for c in TRACKED.split(", ")[1:]]
    line = F.to_json(F.create_map(F.col("filename"), F.struct(*columns)))
    entries.where("filename is not null").select(line.alias("value")).write.mode("overwrite").text(path)
