"""Which input a line comes from: a key for each input, unique within a run.

The key is the path below a root folder, by default the deepest one that holds all inputs:
``part-0.gz`` if all lie in one folder, else ``day=1/part-0.gz``.  Scans, sinks, reports and
streams carry it as ``file_name``.  Two kinds of files are one input: those in a folder
``file_name=<key>/``, as partitioned writers lay them out, and the further parts
``<name>~0001.gz`` of an output that several tasks wrote.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FURTHER = r"(\.gz|\.parquet)~[0-9]{4,}\1$"
_FOLDER = re.compile(r"(?:^|/)file_name=[^/]*(?:/.*)?$")


class Inputs(list):
    """Paths to read, and the root their keys start at (None: to be found by listing them)."""

    def __init__(self, paths: str | Iterable[str], root: str | None = None):
        super().__init__([paths] if isinstance(paths, str) else paths)
        self.root = root if root is not None else getattr(paths, "root", None)


@dataclass(frozen=True)
class Forms:
    """What paths of a run look like, so that keys are worked out line by line as simply as can be."""

    escaped: bool = True  # some characters may be escaped
    named: bool = True  # some are in file_name= folders
    unnamed: bool = True  # some are not
    further: bool = True  # some may be further parts of an output


def _forms() -> tuple[Column, ...]:
    """The four properties over a listing."""
    path, named = F.col("path"), F.col("path").contains("/file_name=")
    return (
        F.coalesce(F.bool_or(path.rlike("[^A-Za-z0-9_./:=~-]")), F.lit(True)),
        F.coalesce(F.bool_or(named), F.lit(True)),
        F.coalesce(F.bool_or(~named), F.lit(True)),
        F.coalesce(F.bool_or(path.contains("~")), F.lit(True)),
    )


@dataclass
class Listing:
    """What a run needs to know of its inputs, from one listing."""

    inputs: Inputs
    total: int  # bytes of gzip files
    largest: int
    names: list[str] | None
    forms: Forms | None = None

    @property
    def root(self) -> str:
        return self.inputs.root


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings spell it, with scheme and without a slash at the end."""
    found, system = hadoop_path(spark, path)
    return found.makeQualified(system.getUri(), system.getWorkingDirectory()).toString().rstrip("/")


def above(first: str, last: str) -> str:
    """The deepest folder that holds both files, but not one that is itself an input."""
    common = [x for x, y in zip(first.split("/")[:-1], last.split("/")[:-1], strict=False)]
    for i, (x, y) in enumerate(zip(first.split("/")[:-1], last.split("/")[:-1], strict=False)):
        if x != y:
            common = common[:i]
            break
    return _FOLDER.sub("", "/".join(common))


def files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """The files to read, as ``path, length``: empty ones too; only the listing is read."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length")


def listing(spark: SparkSession, paths: str | Iterable[str], names: bool = False) -> Listing:
    """List the inputs once: root, sizes, and their keys if ``names`` are wanted."""
    inputs = Inputs(paths)
    root = None if inputs.root is None else qualified(spark, inputs.root)
    found = files(spark, inputs)
    gz = F.when(F.col("path").endswith(".gz"), F.col("length"))
    if names:
        rows = found.select("path", gz.alias("gz")).collect()
        ends = [r.path for r in rows]
        first, last = min(ends, default=""), max(ends, default="")
        total, largest = sum(r.gz or 0 for r in rows), max((r.gz or 0 for r in rows), default=0)
        forms = Forms(
            any(re.search("[^A-Za-z0-9_./:=~-]", path) for path in ends),
            any("/file_name=" in path for path in ends),
            any("/file_name=" not in path for path in ends),
            any("~" in path for path in ends),
        )
    else:
        found = found.agg(F.min("path"), F.max("path"), F.sum(gz), F.max(gz), F.struct(*_forms())).first()
        (first, last, total, largest), forms = found[:4], Forms(*found[4])
    if root is None:
        root = above(first or "", last or "")
    keys = sorted({key_of(path, root) for path in ends}) if names else None
    return Listing(Inputs(inputs, root), total or 0, largest or 0, keys, forms)


def key_of(path: str, root: str) -> str:
    """The key of a listed path (the same rule as ``key_column``)."""
    if found := re.search(r".*/file_name=([^/]*)/", path):
        return unquote(found[1])
    rest = path[len(root) + 1 :] if root and path.startswith(f"{root}/") else path
    return re.sub(_FURTHER, r"\1", rest) if "~" in rest else rest


def _unescaped(text: Column) -> Column:
    return F.when(text.contains("%"), F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).otherwise(text)


def key_column(path: Column, root: str, encoded: bool = True, forms: Forms | None = None) -> Column:
    """The key of the file a row comes from.

    ``path`` is ``_metadata.file_path``, in which characters are escaped (``encoded``), or the
    path of a listing.  ``forms`` are those of all paths that can come, where they are known.
    """
    forms = forms or Forms()
    if encoded and forms.escaped:
        path = _unescaped(path)
    # Worked out for every line, so by plain string functions where they do.
    named = _unescaped(F.substring_index(F.substring_index(path, "/file_name=", -1), "/", 1))
    rest = path
    if root:
        rest = F.when(path.startswith(f"{root}/"), F.substr(path, F.lit(len(root) + 2))).otherwise(path)
    if forms.further:
        rest = F.when(rest.contains("~"), F.regexp_replace(rest, _FURTHER, "$1")).otherwise(rest)
    if not forms.named:
        return rest
    return F.when(path.contains("/file_name="), named).otherwise(rest) if forms.unnamed else named


def relative(spark: SparkSession, paths: Sequence[str], root: str | None = None) -> Inputs:
    """The paths with a root found without listing them, so that any part of them, taken alone,
    gives its files the keys they have among all.  One path alone keeps the root it lists."""
    paths = Inputs(paths, root)
    if paths.root is None and len(paths) > 1:
        fixed = [re.split(r"[*?\[{]", qualified(spark, path), maxsplit=1) for path in paths]
        # Up to the first pattern, a path is a folder or a file in one.
        spelled = sorted(x[0] + ("" if len(x) == 1 else "*") for x in fixed)
        paths.root = above(spelled[0], spelled[-1])
    return paths
