"""Secret scans with corpus-wide ownership frequency.

Every whole text is scanned for three base kinds, which are always reported, and for further
candidates of credential shape. Hashes of all candidates are aggregated over the corpus by distinct
repositories and owners: what many owners have, or very many repositories of few owners, is a widely
copied example; what few have in few repositories is owner-specific and looks live. Further
candidates become spans only if they are owner-specific and do not overlap a base span. The
aggregation first counts by value, owner and repository, so that a value in a third of all documents
is a narrow row per document and then one per owner.

A document is a repository: the table names no larger one. Its source is the owner.

Cases: null text counts as empty; null ids are carried through, and their rows masked as any other;
rows with a null owner count for one nameless owner; repeated rows are scanned as often as they occur,
and count as repositories only once for the same id; very long texts are scanned whole, in one
batch each; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import log2

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import chunks, column_rows, maybe_in, membership_filter, narrow, record_batch, resident, row_key, small_side
from helixframe.storage import scratch

#: Kinds in the order of a listing; the first three are the base.
KINDS = ("assign", "access", "hex", "key_block", "bearer", "prefixed")
#: A value that more owners than this have, or more repositories, is an example that gets copied.
FEW_OWNERS, FEW_REPOSITORIES = 2, 20
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}-----END [A-Z ]*PRIVATE KEY-----")
_PREFIXED = re.compile(r"(?<![A-Za-z0-9])(?:ghp_|gho_|sk-|sk_live_|rk_live_|xox[bp]-|glpat-)[A-Za-z0-9_-]{16,}", re.ASCII)
_RUN = re.compile(r"[A-Za-z0-9_-]*", re.ASCII)
_HINTS = ("-----BEGIN", "eyJ", "ghp_", "gho_", "sk-", "sk_live_", "rk_live_", "xox", "glpat-")
_SPAN = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("value", pa.string())])
_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("key", pa.string()), ("owner", pa.string()), ("base", pa.list_(_SPAN)), ("more", pa.list_(_SPAN))])
_DDL_SPAN = "array<struct<start: long, rank: int, end: long, value: string>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, rank of kind, end, secret part) of the base kinds, by start and kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def entropy(value: str) -> float:
    """Bits a character."""
    return -sum(n / len(value) * log2(n / len(value)) for n in Counter(value).values())


def bearer_spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans of `eyJ` and two more runs behind dots, each of eight characters or more. A run is looked
    at from its first `eyJ` only, as later ones have less before the dot, so that each character is read
    a few times at most, however long the run."""
    at = text.find("eyJ")
    while at >= 0:
        stops = [_RUN.match(text, at).end()]
        for _ in range(2):
            if text[stops[-1] : stops[-1] + 1] == ".":
                stops.append(_RUN.match(text, stops[-1] + 1).end())
        whole = len(stops) == 3 and stops[0] - at >= 11 and all(b - a > 8 for a, b in zip(stops, stops[1:], strict=False))
        if whole:
            yield at, stops[-1]
        at = text.find("eyJ", stops[-1] if whole else stops[0])


def merged(spans: list[tuple[int, int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans, ordered by start, cover together."""
    starts: list[int] = []
    ends: list[int] = []
    for a, _, b, _ in spans:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def further_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Candidates of the further kinds that overlap no base span."""
    if not any(h in text for h in _HINTS):
        return []
    starts, ends = merged(taken)
    found = []
    for kind, spans in ((3, (m.span() for m in _KEY_BLOCK.finditer(text))), (4, bearer_spans(text)), (5, (m.span() for m in _PREFIXED.finditer(text)))):
        for a, b in spans:
            before = bisect_left(starts, b) - 1  # the last stretch that starts before the span ends
            if (before < 0 or ends[before] <= a) and entropy(text[a:b]) >= 3:
                found.append((a, kind, b, text[a:b]))
    return sorted(found)


def _hashed(spans: list[tuple[int, int, int, str]]) -> list[dict]:
    return [{"start": a, "rank": k, "end": b, "value": hashlib.sha256(v.encode("utf-8")).hexdigest()[:32]} for a, k, b, v in spans]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    resident("secrets", tuple)  # lets go of what other operators kept
    made = TaskContext.get().partitionId() << 33
    for batch in batches:
        for rows in chunks(column_rows(batch, ["doc_id", "key", "text", "owner"]), 2048):
            out = []
            for doc_id, key, text, owner in rows:
                base = base_spans(text or "")
                out.append((made, doc_id, key, owner, _hashed(base), _hashed(further_spans(text or "", base))))
                made += 1
            yield record_batch(out, _SCHEMA)


def ownership(candidates: DataFrame) -> DataFrame:
    """(value, repositories, owners) over rows (value, repository, owner)."""
    by_owner = candidates.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one")).groupBy("value", "owner").agg(F.sum("one").alias("repositories"))
    return by_owner.groupBy("value").agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def scan(docs: DataFrame, owner_col: str = "source", few: int = FEW_OWNERS, few_repositories: int = FEW_REPOSITORIES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, key (its row_key), base and spans (arrays of start, rank of kind, end, value,
    ordered), where value is a hash of the secret part; live and copied count the owner-specific
    and the widely copied values among the document's spans."""
    texts = narrow(docs, doc_id=F.col(id_col).cast("long"), key=row_key(F.col(id_col), F.col(text_col)), text=F.col(text_col), owner=F.col(owner_col).cast("string"))
    found = scratch(texts.mapInArrow(_scan, f"row long, doc_id long, key string, owner string, base {_DDL_SPAN}, more {_DDL_SPAN}"), "secrets")
    with_any = found.filter("size(base) + size(more) > 0")
    each = with_any.select("row", F.coalesce("doc_id", "row").alias("repository"), F.coalesce("owner", F.lit("")).alias("owner"), F.explode(F.concat("base", "more")).alias("span"))
    counted = ownership(each.select(F.col("span.value").alias("value"), "repository", "owner"))
    judged = each.select("row", "span", F.col("span.value").alias("value")).join(counted, "value")
    own = (F.col("owners") <= few) & (F.col("repositories") <= few_repositories)
    per_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(own & (F.col("span.rank") > 2), F.col("span")))).alias("added"),
        F.count(F.when(own, 1)).alias("live"),
        F.count(F.when(~own, 1)).alias("copied"),
        F.collect_set(F.when(own, F.col("value"))).alias("live_values"),
    )
    joined = found.drop("more").join(per_row, "row", "left")
    none = F.array().cast(_DDL_SPAN)
    return joined.select(
        "doc_id",
        "key",
        "base",
        F.sort_array(F.concat("base", F.coalesce("added", none))).alias("spans"),
        F.coalesce("live", F.lit(0)).cast("long").alias("live"),
        F.coalesce("copied", F.lit(0)).cast("long").alias("copied"),
        "live_values",
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(text: str | None, live: set[str]) -> str | None:
    """text with the secret part of each span of a live value replaced."""
    if not text or not live:
        return text
    base = base_spans(text)
    spans = sorted((b - len(v), b, KINDS[k]) for a, k, b, v in base + further_spans(text, base) if hashlib.sha256(v.encode("utf-8")).hexdigest()[:32] in live)
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind} removed]"]
            at = b
    return "".join([*out, text[at:]])


def mask_live(docs: DataFrame, owner_col: str = "source", few: int = FEW_OWNERS, few_repositories: int = FEW_REPOSITORIES, text_col: str = "text", count_col: str = "n_chars", id_col: str = "doc_id") -> DataFrame:
    """docs with owner-specific credentials masked in the text and its length set anew; widely
    copied examples stay. All rows and columns stay, and only documents with a live value and
    those that share their filter bits are shuffled, by id and a digest of the text."""
    names = docs.columns
    scanned = scan(docs, owner_col, few, few_repositories, id_col, text_col)
    live = scratch(scanned.filter("size(live_values) > 0").groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("live_values"))).alias("live_values")), "secrets-live")
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_key"))
    marked = maybe_in(packed, F.col("_key"), membership_filter(live, F.col("key")))
    clear = marked.filter(~F.col("_maybe")).select("_row")
    hit = marked.filter("_maybe").join(small_side(live.withColumnRenamed("key", "_live_key")), F.col("_key") == F.col("_live_key"), "left")

    @F.pandas_udf("string")
    def masked(texts: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([mask(t, set(v) if v is not None else set()) for t, v in zip(texts, values, strict=True)], dtype=object)

    text = masked(F.col("_row").getField(text_col), F.col("live_values"))
    changed = hit.withColumn("_text", text)
    field = lambda n: F.col("_text") if n == text_col else F.when(F.col("live_values").isNull(), F.col("_row").getField(n)).otherwise(F.length("_text").cast(docs.schema[n].dataType)) if n == count_col else F.col("_row").getField(n)
    rows = clear.select(*[F.col("_row").getField(n).alias(n) for n in names]).unionByName(changed.select(*[field(n).alias(n) for n in names]))
    return rows
