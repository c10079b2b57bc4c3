"""Secret scans over a ledger of blobs.

A text is addressed by the sha-256 of its content. The ledger, a Parquet folder, holds
what the rules of one version found in one blob, also when that was nothing; a scan
reads only pairs of blob and rule version which the ledger does not hold yet, writes
them to it, and joins the findings back to every path (here: document) of a blob, in
whatever version of the collection. Scanning the same collection again scans nothing.

Copies are combined before the shuffle, so a text that is a third of all rows is
scanned once and moved once per task.

Defined results: a null or empty text is the empty blob, without findings; repeated
documents are answered each for itself; a null id is kept; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavecount.llm.common import slices, texts
from wavecount.session import materialise, new_workdir

#: Names the set of rules below; to be changed with them.
RULE_VERSION = "2"

# The kinds of secrets, in the order of reports, and their patterns. The first three are the base.
BASE = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ADDED = {
    "private_key": ("PRIVATE KEY-----", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")),
    "hub_token": ("gh", re.compile(r"gh[oprsu]_[A-Za-z0-9]{36,}")),
    "chat_token": ("xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    "web_token": ("eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
}
KINDS = (*BASE, *_ADDED)
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

_FINDINGS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed; leftmost and apart within a kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    for kind, (sign, pattern) in _ADDED.items():
        if sign in text:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _blob(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class Ledger:
    """Findings by blob and rule version, below ``path`` in a folder all executors share."""

    SCHEMA = f"blob binary, rules string, findings {_FINDINGS}"

    def __init__(self, path: str):
        self.path = path

    def read(self, spark) -> DataFrame:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return spark.createDataFrame([], self.SCHEMA)
        return spark.read.schema(self.SCHEMA).parquet(self.path)

    def scan(self, docs: DataFrame, rules: str = RULE_VERSION) -> None:
        """Scan the blobs of ``docs`` that were not scanned by these rules, and append them."""
        spark = docs.sparkSession
        seen = self.read(spark).where(F.col("rules") == rules).select("blob")
        blobs = texts(docs).select(_blob(F.col("text")).alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))
        fresh = blobs.join(seen, "blob", "left_anti")

        def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            for part in slices(batches):
                rows = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["blob"], pa.array([rules] * part.num_rows, pa.string()),
                                                  pa.array(rows, kind)], names=["blob", "rules", "findings"])

        fresh.mapInArrow(scanned, self.SCHEMA).write.mode("append").parquet(self.path)

    def findings(self, spark, rules: str = RULE_VERSION) -> DataFrame:
        """Blobs in which these rules found something, once each."""
        rows = self.read(spark).where((F.col("rules") == rules) & (F.size("findings") > 0))
        return rows.select("blob", "findings").dropDuplicates(["blob"])


def scan_documents(docs: DataFrame, ledger: Ledger) -> DataFrame:
    """doc_id and findings of every document; scans what the ledger lacks."""
    ledger.scan(docs)
    paths = texts(docs).select("doc_id", _blob(F.col("text")).alias("blob"))
    found = paths.join(ledger.findings(docs.sparkSession), "blob", "left")
    return found.select("doc_id", F.coalesce("findings", F.array().cast(_FINDINGS)).alias("findings"))


def digest(found: DataFrame) -> DataFrame:
    """Numbers, spans and the digest of the base spans."""
    def spans(rows: Column) -> Column:
        return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["kind"], r["start"], r["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda r: r["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda r: r["kind"].isin(*BASE))
    return found.select("doc_id", *map(number, BASE), F.sha2(spans(base), 256).alias("base_sha256"),
                        spans(F.col("findings")).alias("spans"))


def redact(docs: DataFrame, ledger: Ledger, mark: str = "[SECRET]") -> DataFrame:
    """Documents, all columns kept, with every found secret replaced by a mark and ``n_chars`` set anew.

    The findings are written as a table first, so that Spark knows their real size when
    it chooses how to join; texts without a finding pass unchanged.
    """
    ledger.scan(docs)
    found = materialise(ledger.findings(docs.sparkSession), "findings").withColumnsRenamed({"blob": "_blob", "findings": "_findings"})
    schema = docs.schema
    names = schema.names
    joined = docs.join(found, _blob(F.coalesce("text", F.lit(""))) == F.col("_blob"), "left").drop("_blob")

    def cut(text: str, rows: list[dict]) -> str:
        out, at = [], 0
        for start, end in sorted((r["start"], r["end"]) for r in rows):
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = part["_findings"].to_pylist()
            if any(rows):
                values = [cut(t, r) if r else t for t, r in zip(part["text"].to_pylist(), rows, strict=True)]
                part = part.set_column(names.index("text"), "text", pa.array(values, part["text"].type))
                if "n_chars" in names:
                    sizes = [len(t) if r else n for t, r, n in zip(values, rows, part["n_chars"].to_pylist(), strict=True)]
                    part = part.set_column(names.index("n_chars"), "n_chars", pa.array(sizes, part["n_chars"].type))
            yield part.select(names)

    return joined.mapInArrow(redacted, schema)


def new_ledger(spark, label: str = "ledger") -> Ledger:
    return Ledger(new_workdir(spark, label))
