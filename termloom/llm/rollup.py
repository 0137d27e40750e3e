"""Token totals maintained by signed deltas.

A batch is a set of signed counts: inserts add, deletes subtract, a revised count subtracts
the old and adds the new. It is added up by source, language and tokenizer version and
written to a folder of its own; then a commit file named after the batch, with that folder and
a digest of the rows, is put in place by one rename that fails where the file is there. So a
batch counts from that moment and only once: sending it again changes nothing, two writers
of one batch cannot both win, one that failed half-way counts for nothing, and a name sent
again with other rows is an error. Totals are the sums over committed batches, in whatever
order they came.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.tokens import encoder, tokenizer_path

KEYS = ("source", "lang", "tokenizer")
DELTAS = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
ENTRY = "batch string, folder string, digest string"


def token_count(text: Column, tokenizer: str | None = None) -> Column:
    """Number of tokens of a whole text; 0 for an empty or null one."""
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path)
        for values in batches:
            yield pa.array(
                [len(own.encode(v)) if v else 0 for at in range(0, len(values), 256) for v in values.slice(at, 256).to_pylist()],
                pa.int64(),
            )

    return F.arrow_udf(run, "bigint", functionType=F.ArrowUDFType.SCALAR_ITER)(text)


def signed(rows: DataFrame, tokenizer: str, tokens: str, sign: int) -> DataFrame:
    """Deltas of documents that come (1) or go (-1). Null counts are 0."""
    return rows.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("bigint").alias("docs"),
        (F.coalesce(F.col(tokens), F.lit(0)).cast("bigint") * sign).alias("tokens"),
    )


def inserts(rows: DataFrame, tokenizer: str, tokens: str) -> DataFrame:
    return signed(rows, tokenizer, tokens, 1)


def deletes(rows: DataFrame, tokenizer: str, tokens: str) -> DataFrame:
    return signed(rows, tokenizer, tokens, -1)


def revisions(rows: DataFrame, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """Deltas of counts that change: (tokenizer, column) before and after."""
    return signed(rows, *old, -1).unionByName(signed(rows, *new, 1))


class Ledger:
    """Committed batches below a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        return hadoop, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit_file(self, batch: str) -> str:
        return f"{self.path}/commits/{quote(batch, safe='')}.json"

    def committed(self, batch: str) -> bool:
        hadoop, files = self._files()
        return files.exists(hadoop.Path(self._commit_file(batch)))

    def _publish(self, batch: str, entry: dict[str, str]) -> bool:
        """Put the commit file in place; False when it is there. A name that begins with a dot is
        not read by anybody."""
        hadoop, files = self._files()
        temporary = hadoop.Path(f"{self.path}/commits/.{uuid.uuid4().hex}")
        out = files.create(temporary, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = hadoop.FileContext.getFileContext(temporary.toUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        if self.committed(batch):
            return False
        try:
            context.rename(temporary, hadoop.Path(self._commit_file(batch)), plain)
        except Exception:
            if self.committed(batch):
                return False
            raise
        return True

    @staticmethod
    def _digest(rows: DataFrame) -> str:
        """Equal for equal sets of summed rows, in whatever order."""
        hashes = F.xxhash64(*[F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")) for k in KEYS], "docs", "tokens")
        n, total = rows.agg(F.count("*"), F.coalesce(F.sum(hashes.cast("decimal(38,0)")), F.lit(0))).first()
        return f"{n}:{total}"

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch; False when it was committed before with the same rows, an error when
        with others. An empty batch is one too."""
        if not batch:
            raise ValueError("a batch needs a name")
        added = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        if self.committed(batch):
            own = self._digest(added)
        else:
            folder = uuid.uuid4().hex
            added.write.parquet(f"{self.path}/data/{folder}")
            own = self._digest(self.spark.read.schema(DELTAS).parquet(f"{self.path}/data/{folder}"))
            if self._publish(batch, {"batch": batch, "folder": folder, "digest": own}):
                return True
        known = self.spark.read.schema(ENTRY).json(self._commit_file(batch)).first()
        if known["digest"] != own:
            raise ValueError(f"batch {batch!r} was committed with other rows")
        return False

    def folders(self) -> list[str]:
        """Folders of committed batches; one name per batch comes to the driver, read by tasks."""
        hadoop, files = self._files()
        if not files.exists(hadoop.Path(f"{self.path}/commits")):
            return []
        return [f"{self.path}/data/{r['folder']}" for r in self.spark.read.schema(ENTRY).json(f"{self.path}/commits").collect()]

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens); keys that came to nothing are left out.
        Null sources and languages are groups of their own."""
        found = self.folders()
        rows = self.spark.read.schema(DELTAS).parquet(*found) if found else self.spark.createDataFrame([], DELTAS)
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0 or tokens != 0")
