"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text. The ledger has a row for each
(blob, rule version) pair that was ever scanned; a run scans only pairs it lacks, adds them, and joins
findings back to all paths. Texts are scanned where they are read, each blob once in a task however many
paths hold it; what moves are addresses and findings.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import slices, small, table, tidy

# The rules, in the order in which kinds count at an equal start. Each has the pattern, the
# group whose length counts, the least length, and texts of which one must be there (lower-cased for assign).
RULES = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ("passw", "secret", "token", "api")),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, ("AKIA",)),
    ("hex", r"[0-9a-f]+", 0, 24, ()),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 1, ("-----BEGIN",)),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+", 0, 1, ("eyJ",)),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, ("gh",)),
)
RULE_VERSION, BASE = "2", 3
_COMPILED = [(k, re.compile(p), g, n, need) for k, p, g, n, need in RULES]

LEDGER = "blob binary, rule_version string, n_assign long, n_access long, n_hex long, base string, spans string"


def spans_of(text: str, hex_run: bool = True) -> list[tuple[int, int, int]]:
    """(start, rule number, end) of all findings in a text, sorted; code points, end exclusive."""
    out, low = [], None
    for k, (kind, pattern, group, least, need) in enumerate(_COMPILED):
        if kind == "hex":
            if not hex_run:
                continue
        elif kind == "assign":
            low = text.lower()
            if not any(x in low for x in need):
                continue
        elif not any(x in text for x in need):
            continue
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out)


_HEX = np.zeros(256, bool)
_HEX[ord("0") : ord("9") + 1] = _HEX[ord("a") : ord("f") + 1] = True


def _hex_rows(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts hold 24 hex digits in a row (or, rarely, only together with the next text)."""
    a = _HEX[data]
    for step in (1, 2, 4):
        a = a[:-step] & a[step:] if len(a) > step else a[:0]
    a = a[:-16] & a[8:-8] & a[16:] if len(a) > 16 else a[:0]
    found = np.zeros(len(bounds) - 1, bool)
    found[np.searchsorted(bounds, np.flatnonzero(a), "right") - 1] = True
    return found


#: Addresses that a task remembers; beyond, it forgets them and may scan a blob again.
REMEMBERED = 1 << 20


@tidy
def _scan(batches):
    """Ledger rows of (blob, text), one for each blob of the task."""
    seen: set[bytes] = set()
    for b in batches:
        rows = []
        for i, j, data, bounds in slices(b, "text"):
            run, col = _hex_rows(data, bounds), b.column(1)
            for k, blob in enumerate(b.column(0).slice(i, j - i).to_pylist()):
                if blob in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(blob)
                found = spans_of(col[i + k].as_py(), bool(run[k]))
                name = [f"{RULES[x][0]}:{s}:{e}" for s, x, e in found]
                n = [sum(x == y for _, x, _ in found) for y in range(BASE)]
                rows.append((blob, RULE_VERSION, *n, ",".join(x for x, f in zip(name, found) if f[1] < BASE), ",".join(name)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


_NAMES = [x.split()[0] for x in LEDGER.split(", ")]
_TYPES = [{"binary": pa.binary(), "string": pa.string(), "long": pa.int64()}[x.split()[1]] for x in LEDGER.split(", ")]


def addressed(versions: DataFrame) -> DataFrame:
    """(doc_id, blob, text): every version with the address of its text; null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return versions.select(F.col("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("text"))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger rows for the blobs of versions (doc_id, text) that `ledger` lacks under RULE_VERSION.

    Without a ledger all texts are scanned in place. With one, addresses alone decide which blobs are unseen; the
    texts then meet these once, in place where they are few enough to be broadcast. One row for each blob;
    repeated rows add nothing, and no version gives none.
    """
    rows = addressed(versions).select("blob", "text")
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == RULE_VERSION).select("blob")
        rows = rows.join(rows.select("blob").distinct().join(known, "blob", "left_anti"), "blob", "left_semi")
    return rows.mapInArrow(_scan, LEDGER).dropDuplicates(["blob"])


def _ledger(versions: DataFrame, path: str | None) -> DataFrame:
    """The ledger under RULE_VERSION after the unseen blobs of versions were added to it; one row for each blob."""
    spark = versions.sparkSession
    if not path:
        return table(scan_unseen(versions))
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    scan_unseen(versions, spark.read.schema(LEDGER).parquet(path) if known else None).write.mode("append").parquet(path)
    # runs beside each other, or one repeated after a failure, may have added a pair twice; its rows are alike
    return spark.read.schema(LEDGER).parquet(path).where(F.col("rule_version") == RULE_VERSION).dropDuplicates(["blob"])


def _findings(ledger: DataFrame) -> DataFrame:
    """Ledger rows with findings, to be broadcast if they are few."""
    found = ledger.where("spans <> ''").drop("rule_version")
    size = found.agg(F.sum(F.octet_length("base") + F.octet_length("spans") + 100)).first()[0] or 0
    return small(found, size)


def scan(versions: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Findings of every version: doc_id, blob, n_assign, n_access, n_hex, base, spans.

    versions: (doc_id, text), more columns are ignored. Null and empty texts have no findings ('' and 0).
    One row for each row of versions, repeated and null ids included. ledger_path: a folder that keeps the
    ledger between runs; it is added to, never rewritten, and a pair that several runs added counts once.
    Without it a ledger of this run is used.
    """
    found = _findings(_ledger(versions, ledger_path))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_assign", "n_access", "n_hex")]
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("base", "spans")]
    return addressed(versions).select("doc_id", "blob").join(found, "blob", "left").select("doc_id", "blob", *zero, *text)


def redact(docs: DataFrame, ledger_path: str | None = None, mask: str = "[secret]") -> DataFrame:
    """docs with every span of a finding replaced by `mask`; all columns and rows kept, n_chars brought up to date.

    Overlapping spans become one mask. Texts are scanned as in scan; those without findings stay as they are. Texts
    move once at most, and not at all while the findings are few enough to be broadcast.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = "__blob"
    while name in docs.columns or name + "s" in docs.columns:
        name += "_"
    keyed = docs.withColumn(name, F.unhex(F.sha2(text.cast("binary"), 256)))
    spans = name + "s"
    found = _findings(_ledger(docs, ledger_path)).select(F.col("blob").alias(name), F.col("spans").alias(spans))
    out = keyed.join(found, name, "left")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, all_spans: pa.Array) -> pa.Array:
        return pa.array([_masked(t, s, mask) for t, s in zip(texts.to_pylist(), all_spans.to_pylist())], pa.string())

    hit = F.col(spans).isNotNull()
    clean = F.when(hit, cut(F.when(hit, F.col("text")), F.coalesce(F.col(spans), F.lit("")))).otherwise(F.col("text"))
    kept = [clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = out.select(*kept)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else out


def _masked(text: str | None, spans: str, mask: str) -> str | None:
    if not spans or text is None:
        return text
    out, at = [], 0
    for s, e in sorted(tuple(map(int, x.split(":")[1:])) for x in spans.split(",")):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
