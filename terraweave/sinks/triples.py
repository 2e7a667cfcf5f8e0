"""Writing triples: partitioned text, compression, merging, statistics, header."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..config import Config, option_rows
from ..functions import text as T

#: The engine's version, as the output tells it.
VERSION = "0.2"
CODECS = {"none": "none", "bz2": "bzip2", "gz": "gzip"}
#: Fixed value: the part buffer that a line of the standard output must fit.
LONGEST_LINE = 30 * 1024 * 1024
ENDINGS = {"none": "", "bz2": ".bz2", "gz": ".gz"}


def header(spark: SparkSession, fmt: str, config: Config | None = None) -> DataFrame:
    """(s, p, o) of the prefix declarations; none in "nt"."""
    own = dict(V.PREFIXES)
    if config is not None and config.iri_prefix_for_untagged_nodes:
        own["osmnode_untagged"] = own["ohmnode_untagged"] = config.iri_prefix_for_untagged_nodes
    rows = [] if fmt == "nt" else [("@prefix", f"{p}:", f"<{iri}>") for p, iri in sorted(own.items())]
    return spark.createDataFrame(rows, "s string, p string, o string")


def metadata(spark: SparkSession, config: Config, *, dumped: datetime | None = None) -> DataFrame:
    """(s, p, o) of the options in effect; with `dumped` also the engine's version and
    when the output was made."""
    fmt = config.output_format
    rows = spark.createDataFrame(option_rows(config), "name string, text string, kind string")
    value = T.string_literal("text")
    for kind in ("boolean", "integer", "double"):
        value = F.when(F.col("kind") == kind, T.typed(F.col("text"), kind, fmt)).otherwise(value)
    option = T.iri(V.INFO, F.col("name"), "nt") if fmt == "nt" else F.concat(F.lit(f"{V.INFO}:"), "name")
    told = rows.select(T.term((V.INFO, "option"), fmt).alias("s"), option.alias("p"), value.alias("o"))
    if dumped is None:
        return told
    own = spark.createDataFrame([("version", VERSION, None), ("dateDumped", dumped.strftime("%Y-%m-%dT%H:%M:%S"), "dateTime")], "name string, text string, kind string")
    name = T.iri(V.INFO, F.col("name"), "nt") if fmt == "nt" else F.concat(F.lit(f"{V.INFO}:"), "name")
    text = F.when(F.col("kind") == "dateTime", T.typed(F.col("text"), "dateTime", fmt)).otherwise(T.string_literal("text"))
    return own.select(T.term((V.INFO, "info"), fmt).alias("s"), name.alias("p"), text.alias("o")).unionByName(told)


def with_ending(path: str, compression: str) -> str:
    """The path with the compression's ending, once."""
    ending = ENDINGS[compression]
    return path if path.endswith(ending) else path + ending


def part_name(prefix: str, number: int, parts: int) -> str:
    """`prefix.part_` and the number, as wide as the number of parts."""
    return f"{prefix}.part_{number:0{len(str(parts))}d}"


def write(triples: DataFrame, path: str, *, compression: str = "bz2", parts: int | None = None) -> str:
    """One text file per partition below `path`; a failed task leaves none behind."""
    lines = triples.select(T.line().alias("value"))
    if parts:
        lines = lines.repartition(parts)
    lines.write.mode("overwrite").option("compression", CODECS[compression]).text(path)
    return path


def merge(spark: SparkSession, folder: str, target: str, *, keep: bool = False, first: str | None = None) -> str:
    """Part files joined byte by byte into one file: streams of bz2 and gz may follow
    each other. `first` is a folder whose parts come before. For small outputs; large
    ones stay in parts."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    fs = path_of(folder).getFileSystem(conf)
    out = fs.create(path_of(target), True)
    try:
        for source in filter(None, (first, folder)):
            found = sorted(s.getPath().toString() for s in fs.listStatus(path_of(source)) if s.getPath().getName().startswith("part-"))
            for part in found:
                stream = fs.open(path_of(part))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
                stream.close()
    finally:
        out.close()
    if not keep:
        for source in filter(None, (first, folder)):
            fs.delete(path_of(source), True)
    return target


def to_stdout(triples: DataFrame, longest: int = LONGEST_LINE) -> Iterator[str]:
    """The lines one partition at a time, for printing; one of more characters raises."""
    for row in triples.select(T.line().alias("value")).toLocalIterator():
        if len(row.value) > longest:
            raise ValueError(f"a line of {len(row.value)} characters does not fit the output buffer")
        yield row.value


def statistics_path(output: str) -> str:
    """Beside the output, named before any compression ending."""
    return f"{output}.stats.json"


def _written(spark: SparkSession, path: str, text: str) -> None:
    """A small file of this text."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def name_parts(spark: SparkSession, folder: str, prefix: str, *, first: str | None = None) -> list[str]:
    """Parts below `folder` under the names of `part_name`, and the order in which they make one
    output in `folder`/MANIFEST, those of `first` before; nothing is copied."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def parts(where: str) -> list[str]:
        return sorted(s.getPath().getName() for s in fs.listStatus(path_of(where)) if s.getPath().getName().startswith("part-"))

    found = [(where, name) for where in (first, folder) if where for name in parts(where)]
    names = []
    for number, (where, name) in enumerate(found):
        names.append(part_name(prefix, number, len(found)))
        if not fs.rename(path_of(f"{where}/{name}"), path_of(f"{folder}/{names[-1]}")):
            raise OSError(f"cannot name {where}/{name}")
    if first:
        fs.delete(path_of(first), True)
    _written(spark, f"{folder}/MANIFEST", "".join(f"{n}\n" for n in names))
    return names


def write_statistics(spark: SparkSession, counted: dict[str, int], output: str, header_lines: int) -> dict:
    """The counters of what was written (stats.output_counters), as JSON beside the output."""
    triples = counted["triples"]
    found = {"blankNodes": counted["blankNodes"], "header": header_lines, "lines": triples + header_lines, "triples": triples}
    _written(spark, statistics_path(output), json.dumps(found))
    return found
