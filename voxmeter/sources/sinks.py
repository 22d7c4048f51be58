"""Where results go: parquet, single CSV files, JSON summaries, Markdown, a staged folder with its manifest."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

MISSING = "—"


def write_parquet(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A report table as one CSV folder with a header; report tables are small."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report table read back with its schema; an empty file is an empty table."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def interval_text(lo: float | None, hi: float | None, digits: int = 4) -> str:
    return MISSING if lo is None or hi is None else f"[{lo:.{digits}f}, {hi:.{digits}f}]"


def percent_text(share: float | None, digits: int = 1) -> str:
    return MISSING if share is None else f"{100 * share:.{digits}f}%"


def _cell(v) -> str:
    if v is None:
        return MISSING
    return f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|")


def markdown(title: str, tables: dict[str, DataFrame], most: int = 1000) -> str:
    """Report tables in Markdown, empty ones left out; a table of more rows than most is cut with a note."""
    out = [f"# {title}", ""]
    for name, df in tables.items():
        rows = df.limit(most + 1).collect()
        if rows:
            out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
            out += ["| " + " | ".join(map(_cell, r)) + " |" for r in rows[:most]]
            out += ["", f"Only the first {most} rows are shown.", ""] if len(rows) > most else [""]
    return "\n".join(out)


def write_summary(path: str | Path, content: dict) -> None:
    Path(path).write_text(_json(content))


def _json(content: dict) -> str:
    return json.dumps(content, ensure_ascii=False, indent=2, default=str) + "\n"


class Folder:
    """A folder on whatever file system its path names, through Spark's own access to it."""

    def __init__(self, spark: SparkSession, path: str | Path):
        self.jvm, self.path = spark._jvm, str(path)
        self.root = self.jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.at(name))

    def has(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def is_empty(self) -> bool:
        return not self.fs.exists(self.root) or not len(self.fs.listStatus(self.root))

    def renew(self) -> None:
        self.fs.delete(self.root, True)
        self.fs.mkdirs(self.root)

    def rename(self, name: str, to: str) -> None:
        target = self._path(to)
        self.fs.mkdirs(target.getParent())
        if not self.fs.rename(self._path(name), target):
            raise OSError(f"{self.at(name)} can't be renamed to {to}")

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self._path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def files(self) -> list[tuple[str, int]]:
        """(path within the folder, bytes) of every file, checksums of the file system aside."""
        found, it = [], self.fs.listFiles(self.root, True)
        base = self.fs.makeQualified(self.root).toUri().getPath().rstrip("/") + "/"
        while it.hasNext():
            f = it.next()
            found.append((f.getPath().toUri().getPath()[len(base) :], f.getLen()))
        return sorted(x for x in found if not x[0].rsplit("/", 1)[-1].endswith(".crc"))


def console_table(headers: Sequence[str], rows: Sequence[Sequence]) -> str:
    cells = [list(map(str, headers)), *(list(map(_cell, r)) for r in rows)]
    widths = [max(len(r[i]) for r in cells) for i in range(len(headers))]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(r, widths)).rstrip() for r in cells)


def folder_for(template: str, day: date | None = None) -> str:
    return template.replace("{date}", (day or date.today()).isoformat())


def description(title: str, facts: dict, files: Sequence[tuple[str, int]], tables: dict[str, DataFrame]) -> str:
    """What a staged folder holds, from what is in it: the facts of the run, its files by folder, and the tables."""
    sizes: dict[str, list[int]] = {}
    for path, size in files:
        sizes.setdefault("/".join(path.split("/")[:2]), []).append(size)
    out = [f"# {title}", "", *(f"- {k}: {v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, default=str)}" for k, v in facts.items() if not k.startswith("_")), ""]
    out += ["| in this folder | files | bytes |", "|---|---|---|", *(f"| {k} | {len(v)} | {sum(v)} |" for k, v in sorted(sizes.items())), ""]
    return "\n".join(out) + markdown("Tables", tables).replace("# Tables", "", 1) if tables else "\n".join(out)


def stage(tables: dict[str, DataFrame], pools: dict[str, DataFrame], folder: str | Path, title: str, facts: dict, parts: Sequence[str] = ("tables", "pools", "summary", "readme")) -> list[tuple[str, int]]:
    """A fresh folder, on any file system, with the wanted parts of a run; returns its files. Nothing is sent anywhere.

    A folder that isn't empty is replaced only if it was staged before, which its MANIFEST.json shows; any other is an
    error. Keys of facts that begin with an underscore are left out.
    """
    frames = [*tables.values(), *pools.values()]
    spark = frames[0].sparkSession if frames else SparkSession.active()
    root = Folder(spark, folder)
    if not root.is_empty() and not root.has("MANIFEST.json"):
        raise FileExistsError(f"{folder} isn't empty and wasn't staged by this engine")
    root.renew()
    if "tables" in parts:
        for name, df in tables.items():
            write_csv(df, root.at(f"tables/{name}"))
    if "pools" in parts:
        for name, df in pools.items():
            write_parquet(df, root.at(f"pools/{name}"))
    if "summary" in parts:
        root.write("summary.json", _json({k: v for k, v in facts.items() if not k.startswith("_")}))
    if "readme" in parts:
        root.write("README.md", description(title, facts, root.files(), tables))
    root.write("MANIFEST.json", _json({"title": title, "files": dict(root.files())}))
    return root.files()
