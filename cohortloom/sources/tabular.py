"""Tables of unknown delimiter, packed or not, workbooks, and archives of them."""

from __future__ import annotations

import csv
import gzip
import io
import re
import tarfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import ship

# Texts that tables use for a missing value.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
ROWS = "path string, member string, row_ord long, cells array<string>, error string"


def sniff_delimiter(sample: str) -> str:
    """The delimiter of the first lines: the candidate with the most fields that every line has alike; a tab if none is."""
    lines = [x for x in sample.splitlines() if x and not x.startswith("#")][:20]
    best, most = "\t", 1
    for d in "\t,;|":
        counts = {len(row) for row in csv.reader(lines, delimiter=d)} if lines else {1}
        if len(counts) == 1 and next(iter(counts)) > most:
            best, most = d, next(iter(counts))
    return best


def _unzipped(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def text_rows(content: bytes) -> Iterator[list[str]]:
    """Rows of a delimited text; lines that begin with # are comments."""
    text = _unzipped(content).decode("utf-8-sig", "replace")
    yield from csv.reader((x for x in text.splitlines() if x and not x.startswith("#")), delimiter=sniff_delimiter(text[:65536]))


def workbook_rows(content: bytes) -> Iterator[list[str]]:
    """Rows of the first sheet of an .xlsx workbook, by its XML."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        sheet = min(n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        for row in ElementTree.fromstring(book.read(sheet)).iter(f"{{{ns['m']}}}row"):
            cells: list[str] = []
            for c in row.findall("m:c", ns):
                letters = re.match(r"[A-Z]+", c.get("r", ""))
                if letters:
                    at = 0
                    for ch in letters[0]:
                        at = at * 26 + ord(ch) - 64
                    cells += [""] * (at - 1 - len(cells))
                value = c.find("m:v", ns)
                inline = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
                cells.append(shared[int(value.text)] if c.get("t") == "s" and value is not None else value.text or "" if value is not None else inline)
            yield cells


def archive_members(content: bytes, name: str) -> Iterator[tuple[str, bytes]]:
    """(member, bytes) of a zip or tar archive; a plain file is its own member ''."""
    low = name.lower()
    if low.endswith((".tar", ".tar.gz", ".tgz")):
        with tarfile.open(fileobj=io.BytesIO(content)) as tar:
            for m in tar:
                if m.isfile():
                    yield m.name, tar.extractfile(m).read()
    elif low.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as book:
            for n in book.namelist():
                if not n.endswith("/"):
                    yield n, book.read(n)
    else:
        yield "", content


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, row_ord, cells, error): all rows of all tables under a path; row 0 is the header.

    A file or member that can't be read gives one row with its error and no cells.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    members = list(archive_members(content, file))
                except (tarfile.TarError, zipfile.BadZipFile, OSError, EOFError) as e:
                    yield pd.DataFrame([(file, "", 0, None, type(e).__name__)], columns=names)
                    continue
                for member, data in members:
                    rows = []
                    try:
                        read = workbook_rows if (member or file).lower().endswith(".xlsx") else text_rows
                        for i, cells in enumerate(read(data)):
                            rows.append((file, member, i, cells, None))
                            if len(rows) >= 20_000:
                                yield pd.DataFrame(rows, columns=names)
                                rows = []
                    except Exception as e:  # noqa: BLE001 - a broken table is a result, not a failure
                        rows = [(file, member, 0, None, type(e).__name__)]
                    yield pd.DataFrame(rows, columns=names)

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, ROWS)


def member_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, n_bytes) of the archives under a path; unreadable ones have no row."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(file, m, len(b)) for m, b in archive_members(content, file) if m]
                except (tarfile.TarError, zipfile.BadZipFile, OSError, EOFError):
                    rows = []
                yield pd.DataFrame(rows, columns=["path", "member", "n_bytes"])

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, member string, n_bytes long")


def matrix_cells(rows: DataFrame) -> DataFrame:
    """(path, member, feature_id, sample_id, value) of tables whose first column is the feature; missing texts and no numbers are null."""
    header = rows.where("row_ord = 0 and cells is not null").select("path", "member", F.col("cells").alias("names"))
    body = rows.where("row_ord > 0 and cells is not null").select("path", "member", "cells")
    pairs = F.arrays_zip(F.slice("names", 2, F.size("names")), F.slice("cells", 2, F.size("names")))
    long = body.join(header, ["path", "member"]).select("path", "member", F.col("cells")[0].alias("feature_id"), F.explode(pairs).alias("c"))
    value = F.when(~F.col("c.1").isin(MISSING), F.col("c.1").try_cast("double"))
    return long.select("path", "member", "feature_id", F.col("c.0").alias("sample_id"), F.nanvl(value, F.lit(None).cast("double")).alias("value"))


def write_matrix(cells: DataFrame, path: str, places: int = 3) -> None:
    """Long cells as packed tab-separated text, rounded; a matrix is kept long, a wide form is made by ``operators.matrix.wide``."""
    cells.withColumn("value", F.round("value", places)).write.mode("overwrite").option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
