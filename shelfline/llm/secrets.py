"""Secret scanning with a ledger of blobs, so that content is scanned once per rule version.

Every version of every file is addressed by the hash of its content. The ledger holds the pairs of
blob and rule version that have been scanned, and the findings per blob. A run scans only pairs that
are not there yet, one copy of each blob, appends to both, and joins findings back to every path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import bitmap, in_bitmap, landed, named_back, neutral, new_path


@dataclass(frozen=True)
class Rule:
    """`pattern` gives leftmost, non-overlapping matches; those whose `group` is shorter than `least`
    are dropped. `rough` is a cheap test that every text with a finding passes."""
    kind: str
    pattern: str
    rough: str
    least: int
    group: int = 0
    version: int = 1
    any_case: bool = False


# --- fixed values: the kinds and patterns that results are compared by ---
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", 6, group=2, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", 20),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}", 24),
)
# --- end of fixed values ---

SCANNED = "blob binary, kind string, version int"
FINDINGS = "blob binary, kind string, version int, start int, end int"
_REDACTED = "[REDACTED]"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def spans_in(text: str, rule: Rule, compiled: re.Pattern) -> list[tuple[int, int]]:
    return [m.span() for m in compiled.finditer(text) if len(m[rule.group]) >= rule.least]


def compiled(rules: Sequence[Rule]) -> list[tuple[Rule, re.Pattern]]:
    return [(r, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0))) for r in rules]


class Ledger:
    """Two append-only tables in a shared folder: what was scanned and what was found."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            # listing happens here: a folder without files is an empty ledger
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    @property
    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    @property
    def findings(self) -> DataFrame:
        # a run that failed between its two writes has findings nobody vouches for, and its repeat adds them again
        return self._read("findings", FINDINGS).join(self.scanned.distinct(), ["blob", "kind", "version"], "left_semi").distinct()


def scan(history: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, keys: Sequence[str] = ("doc_id",)) -> int:
    """Brings the ledger up to date with `history` (a row per version: key columns and `text`).

    Returns the number of pairs of blob and rule version that were scanned. A null text is the empty
    blob. Copies share one scan, that of the row whose key hashes lowest; rows that repeat both key
    and content are scanned again, to the same findings. Every distinct content is scanned whole.
    """
    spark = history.sparkSession
    wanted = spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")
    # one place per blob: aggregated before the shuffle, so a blob that a third of the rows share is a row per task
    texts = history.select(blob_of(F.col("text")).alias("blob"), F.xxhash64(*keys).alias("place"), "text")
    places = landed(texts.groupBy("blob").agg(F.min("place").alias("place")), "places")
    due = (places.crossJoin(F.broadcast(wanted))
           .join(ledger.scanned, ["blob", "kind", "version"], "left_anti"))
    due = landed(due.groupBy("blob").agg(F.collect_list(F.struct("kind", "version")).alias("due"),
                                         F.first("place").alias("place")), "due")
    pairs = due.agg(F.sum(F.size("due"))).first()[0] or 0
    if not pairs:
        return 0
    # the text side streams past the hashed places; it is neither sorted nor gathered by content
    chosen = texts.join(due.hint("shuffle_hash"), ["blob", "place"]).select("blob", "due", "text")
    found = chosen.mapInArrow(_scanner(rules), FINDINGS)
    found.write.mode("append").parquet(f"{ledger.path}/findings")
    due.select("blob", F.explode("due").alias("pair")).select("blob", "pair.*").write.mode("append").parquet(
        f"{ledger.path}/scanned")
    return pairs


def _scanner(rules: Sequence[Rule]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = compiled(rules)
        for batch in batches:
            blobs, due = batch.column("blob"), batch.column("due")
            texts = batch.column("text").fill_null("")
            out: tuple[list, ...] = ([], [], [], [], [])
            for rule, pattern in own:
                likely = pc.match_substring_regex(texts, rule.rough)
                for i in pc.indices_nonzero(likely).to_pylist():
                    if {"kind": rule.kind, "version": rule.version} in due[i].as_py():
                        for start, end in spans_in(texts[i].as_py(), rule, pattern):
                            for column, value in zip(out, (blobs[i].as_py(), rule.kind, rule.version, start, end)):
                                column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, (pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32()))],
                names=["blob", "kind", "version", "start", "end"])
    return find


def per_blob(ledger: Ledger, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, found): spans of the current rule versions, by start, then kind as the rules list it.

    A blob's spans are bounded by its own length."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    now = {(r.kind, r.version) for r in rules}
    current = ledger.findings.where(F.concat_ws(":", "kind", "version").isin([f"{k}:{v}" for k, v in now]))
    return current.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
        "start", order[F.col("kind")].alias("nth"), "end", "kind"))).alias("found"))


def findings_by_path(history: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES,
                     keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The key columns of every row of `history` with `found` (null where its content has no finding)."""
    addressed = history.select(*keys, blob_of(F.col("text")).alias("blob"))
    return addressed.join(per_blob(ledger, rules), "blob", "left")


def report(documents: DataFrame, rules: Sequence[Rule] = RULES, ledger: Ledger | None = None) -> DataFrame:
    """Per row of documents: counts by kind, spans, and their digest. A null id keeps its row."""
    ledger = ledger or Ledger(documents.sparkSession, new_path(documents.sparkSession, "ledger"))
    docs = documents.select(F.col("doc_id").cast("bigint"), "text")
    scan(docs, ledger, rules)
    rows = findings_by_path(docs, ledger, rules)
    found = F.coalesce("found", F.array().cast("array<struct<start:int,nth:int,end:int,kind:string>>"))
    spans = F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select("doc_id", *[count(r.kind) for r in rules], F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def redacted(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """All rows and columns of `docs`, whatever their names, with the secrets in `text` replaced; a null text
    stays null, an empty one empty, repeated rows stay. An empty table gives an empty one.

    `n_chars`, where there is such a column, follows the new text. Rows whose content has no finding, nearly
    all, pass a bitmap of the contents that have one and are not shuffled."""
    spark = docs.sparkSession
    ledger = Ledger(spark, new_path(spark, "ledger"))
    scan(docs, ledger, rules)
    spans = landed(per_blob(ledger, rules).withColumn("mark", F.xxhash64("blob")), "found")
    rows = neutral(docs, F.col("text").alias("content"), blob_of(F.col("text")).alias("blob"))
    rows = rows.withColumn("mark", F.xxhash64("blob"))
    bits = spark.sparkContext.broadcast(bitmap(spans, "mark"))

    def side(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(in_bitmap(bits.value, batch.column("mark").to_numpy()) == wanted))
        return run
    likely = rows.mapInArrow(side(True), rows.schema).join(spans.select("blob", "found"), "blob", "left")
    found, text = F.col("found"), F.col("content")
    # pieces between spans; overlapping spans of different kinds share one mark
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"))
    cut = F.aggregate(
        found, state,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"] + 1).alias("at"),
            F.when(x["start"] + 1 >= acc["at"], F.concat(
                acc["text"], F.substring(text, acc["at"], x["start"] + 1 - acc["at"]), F.lit(_REDACTED)))
            .otherwise(acc["text"]).alias("text")),
        lambda acc: F.concat(acc["text"], F.substring(text, acc["at"], F.length(text))))
    new = F.when(found.isNull() | text.isNull(), text).otherwise(cut)
    changed = {"text": new}
    clean = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"], clean["n_chars"] = F.length(new).cast(kind), F.length(text).cast(kind)
    return named_back(likely, docs, **changed).unionByName(named_back(rows.mapInArrow(side(False), rows.schema), docs, **clean))
