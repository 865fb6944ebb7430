"""Sinks: zstd Parquet, shards, CSV with byte-order mark, JSON lines, metrics, manifests, HTML tables."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parquet(df: DataFrame, path: str, shard: str | None = None) -> None:
    """Overwrite ``path``; with ``shard`` one folder per value, each written by its own tasks."""
    writer = (df.repartition(shard) if shard else df).write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(shard) if shard else writer).parquet(path)


def csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """CSV with a header; the byte-order mark goes before the first column's name."""
    named = df.toDF("﻿" + df.columns[0], *df.columns[1:]) if bom else df
    named.write.mode("overwrite").option("header", True).option("quoteAll", False).csv(path)


def json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def metrics(df: DataFrame, path: str | None = None) -> dict:
    """The single row of ``df`` as a dictionary, written as pretty JSON where a path is given."""
    row = df.first().asDict(recursive=True)
    if path:
        Path(path).write_text(json.dumps(row, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    return row


def manifest(df_path: str, spark) -> DataFrame:
    """path, bytes and SHA-256 of every file below a folder, hashed by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(df_path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def config_yaml(values: dict) -> str:
    return "".join(f"{k}: {json.dumps(v, ensure_ascii=False)}\n" for k, v in values.items())


def html_report(title: str, tables: dict[str, DataFrame], limit: int = 50) -> str:
    """A page with the first rows of each table."""
    parts = [f"<!DOCTYPE html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        rows = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in df.limit(limit).collect())
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>" + "".join(f"<th>{html.escape(c)}</th>" for c in df.columns) + f"</tr>{rows}</table>")
    return "".join(parts)


def markdown_table(df: DataFrame, limit: int = 50) -> str:
    head = "| " + " | ".join(df.columns) + " |\n|" + "-|" * len(df.columns) + "\n"
    return head + "".join("| " + " | ".join(str(v) for v in r) + " |\n" for r in df.limit(limit).collect())
