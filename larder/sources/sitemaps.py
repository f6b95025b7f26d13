"""Sitemaps, from the roots through index files of any depth to the URLs.

Files are read by the tasks, one after the other, gzipped or not, as streams of XML: neither a file nor the
list of files is held by the driver. Each level's index files give the files of the next; a file is read
once, so indexes that list one another come to an end. What isn't there or isn't XML gives what could be
read of it.
"""

from __future__ import annotations

import gzip
import io
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.sources.folders import kept

ENTRIES = "file string, kind string, loc string, lastmod string"


def entries(stream) -> Iterator[tuple[str, str, str | None]]:
    """(``url`` or ``sitemap``, loc, lastmod) of each entry of a file."""
    kind, loc, lastmod = None, None, None
    try:
        for event, node in ET.iterparse(stream, events=("start", "end")):
            tag = node.tag.rpartition("}")[2]
            if event == "start":
                if tag in ("url", "sitemap"):
                    kind, loc, lastmod = tag, None, None
            elif tag == "loc" and kind and loc is None:
                loc = (node.text or "").strip()
            elif tag == "lastmod":
                lastmod = (node.text or "").strip() or None
            elif tag == kind:
                if loc:
                    yield kind, loc, lastmod
                kind = None
                node.clear()
            elif not kind:
                node.clear()
    except (ET.ParseError, EOFError, gzip.BadGzipFile, OSError):
        return


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.column("file").to_pylist():
            rows: list[tuple] = []
            try:
                fs, path = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", file))
                raw = io.BufferedReader(fs.open_input_stream(path, compression=None))
            except (OSError, pa.ArrowInvalid):
                continue
            with raw:
                stream = gzip.GzipFile(fileobj=raw) if raw.peek(2)[:2] == b"\x1f\x8b" else raw
                for row in entries(stream):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _batch(file, rows)
                        rows = []
            yield _batch(file, rows)


def _batch(file: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), *(pa.array(c, pa.string()) for c in columns)], ["file", "kind", "loc", "lastmod"])


def followed(roots: DataFrame, place: Column, *, deepest: int = 50) -> DataFrame:
    """(url, lastmod, depth) of all URLs below ``roots(loc)``, each with the smallest depth that lists it.

    ``place`` says, of a column ``loc``, which file stands for it: fetched sitemaps are files. No chain of
    indexes goes on for more than ``deepest`` levels of new files.
    """
    files = kept(roots.select(place.alias("file")).where("file is not null").distinct(), "sitemaps")
    seen, found, depth = files, [], 0
    while depth < deepest and not files.isEmpty():
        listed = kept(files.repartition("file").mapInArrow(_read, ENTRIES), "listed")
        found.append(listed.where("kind = 'url'").select(F.col("loc").alias("url"), "lastmod", F.lit(depth).alias("depth")))
        new = listed.where("kind = 'sitemap'").select(place.alias("file")).where("file is not null").distinct()
        files = kept(new.join(seen, "file", "left_anti"), "sitemaps")
        seen, depth = seen.unionByName(files), depth + 1
    every = found[0] if found else roots.select(F.lit("").alias("url"), F.lit("").alias("lastmod"), F.lit(0).alias("depth")).limit(0)
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("url").agg(F.min(F.struct("depth", "lastmod")).alias("r")).select("url", "r.lastmod", "r.depth")


def written(files: DataFrame, folder: str) -> int:
    """Write ``files(name, value)`` below a folder, gzipped where the name says so; how many there are. A file gets its name when it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                fs, path = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", f"{folder}/{name}"))
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                data = (value or "").encode()
                with fs.open_output_stream(f"{path}.{attempt}.tmp", compression=None) as out:
                    out.write(gzip.compress(data, mtime=0) if name.endswith(".gz") else data)
                fs.move(f"{path}.{attempt}.tmp", path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return files.select("name", "value").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
