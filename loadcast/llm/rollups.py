"""Token counts as rollups that signed changes keep up to date.

A batch of changes is reduced to signed sums per source, language and tokenizer version and stored in a folder of its
own. The success marker of the folder is the commit: a batch that is committed already is left alone, so a replay adds
nothing, and a batch that broke off is written anew. Totals are the sums over all committed folders, or over a
snapshot and the folders after it.

A null source, language or count is a value of its own for the keys and 0 for the count; equal rows count once each;
an empty batch commits and changes nothing; columns that are not named are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache
from urllib.parse import quote

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")


def inserted(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Changes that add documents; `rows` holds one row per document with `n_tokens`."""
    return _signed(rows, keys, 1)


def deleted(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Changes that take documents back, with the keys and counts under which they were added."""
    return _signed(rows, keys, -1)


def revised(old: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Changes that replace documents by other keys or counts."""
    return deleted(old, keys).unionByName(inserted(new, keys))


def _signed(rows: DataFrame, keys: Sequence[str], sign: int) -> DataFrame:
    tokens = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long")
    return rows.select(*keys, F.lit(sign).cast("long").alias("n_docs"), (tokens * sign).alias("n_tokens"))


def library_counts(
    df: DataFrame, keep: Sequence[str], text: str = "text", ranks: str = "byte_bpe_50k.tiktoken"
) -> DataFrame:
    """The kept columns and `n_tokens` per row under a byte-level vocabulary, as its library counts; a null text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = byte_encoding(ranks)
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t or "")) for t in batch.column(len(keep)).to_pylist()]
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_tokens"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema), "n_tokens long"])
    return df.select(*keep, text).mapInArrow(run, schema)


@lru_cache(maxsize=2)
def byte_encoding(ranks: str) -> tiktoken.Encoding:
    with open(public_tokenizers.path(ranks), "rb") as file:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})


class Rollup:
    """Additive totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = KEYS):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)

    def _folders(self, kind: str) -> list[str]:
        """Names of the committed folders of a kind."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop(f"{self.path}/{kind}")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        names = [s.getPath().getName() for s in files.listStatus(root)]
        return sorted(n for n in names if files.exists(hadoop(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def _summed(self, changes: DataFrame) -> DataFrame:
        return changes.groupBy(*self.keys).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def _covered(self) -> tuple[str | None, set[str]]:
        """The newest snapshot and the batches in it."""
        snapshots = self._folders("snapshots")
        if not snapshots:
            return None, set()
        names = self.spark.read.schema("batch string").parquet(f"{self.path}/members/{snapshots[-1]}")
        return snapshots[-1], {r.batch for r in names.collect()}

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch under its name; False if it is committed already. Only sums per key are stored."""
        name = quote(batch, safe="")
        if name in self._covered()[1] or name in self._folders("batches"):
            return False
        self._summed(changes).write.mode("overwrite").parquet(f"{self.path}/batches/{name}")
        return True

    def _read(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*folders)

    def totals(self) -> DataFrame:
        """One row per key that has documents or tokens left."""
        snapshot, covered = self._covered()
        folders = [f"{self.path}/batches/{n}" for n in self._folders("batches") if n not in covered]
        if snapshot:
            folders.append(f"{self.path}/snapshots/{snapshot}")
        if not folders:
            raise ValueError(f"no batch is committed in {self.path}")
        return self._summed(self._read(folders)).filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot. The list of its batches is written first and counts only
        once the snapshot itself is there."""
        snapshot, covered = self._covered()
        batches = sorted(covered | set(self._folders("batches")))
        name = f"{int(snapshot or 0) + 1:09d}"
        members = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        members.write.mode("overwrite").parquet(f"{self.path}/members/{name}")
        self.totals().write.mode("overwrite").parquet(f"{self.path}/snapshots/{name}")
