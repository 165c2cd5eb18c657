"""Secret scans with multipart credential linking.

Three patterns are strong enough to stand alone (assigned secrets, access identifiers, long hexadecimal runs).
Weaker parts say little by themselves: a login name, a random-looking string, an address.  They
are reported only where complementary parts of one credential stand together: each identifier opens an interval
around itself, cut off at the ends of its scope (lines without an empty line between them), and an interval
join keeps the secrets that fall into one, the identifiers that found a secret, and the endpoints near both.

A scope lies in one text, so the join runs where the text is and nothing is shuffled.  It is a search in
sorted interval bounds over a whole batch of texts: no pairs are listed, however many parts a text has.

Defined results: a null text is empty and has no spans; repeated rows are scanned alike.  The column ``secrets`` replaces one of
that name; other columns stay as they are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points that an identifier reaches to either side.
REACH = 300
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "identifier", "secret", "endpoint")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a shorter run never is a part of a longer one
# A name may follow a prefix that ends in _ or -, as in GITHUB_CLIENT_ID or db-host.
_IDENTIFIER = re.compile(
    r"""(?<![A-Za-z0-9])(?:(?-i:ASIA[A-Z0-9]{16})(?![A-Za-z0-9])|(?:access_?key(?:_?id)?|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{4,})""",
    re.ASCII | re.IGNORECASE,
)
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+={0,2}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}|(?<![A-Za-z0-9])(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::\d{2,5})?""", re.ASCII | re.IGNORECASE)
_BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("partner", pa.int32())])
_SPANS = "array<struct<kind:string,start:int,end:int,partner:int>>"
Part = tuple[int, int, int]


def base_parts(text: str) -> list[Part]:
    """(kind number, start, end) of the parts that stand alone."""
    out = [(0, *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return out + [(2, *m.span()) for m in _HEX.finditer(text)]


def _random_looking(value: str) -> bool:
    kinds = (any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value))
    return all(kinds) and len(set(value)) >= 12


def weak_parts(text: str, base: list[Part]) -> list[Part]:
    """Parts that need company, outside the base spans; none if there is no identifier at all."""
    own = [(3, *m.span()) for m in _IDENTIFIER.finditer(text)]
    if not own and not any(k == 1 for k, _, _ in base):
        return []
    own += [(4, *m.span()) for m in _SECRET.finditer(text) if _random_looking(m.group())]
    own += [(5, *m.span()) for m in _ENDPOINT.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.empty(0, int)
    free = []
    for kind, start, end in own:
        k = int(np.searchsorted(starts, end)) - 1
        if k < 0 or reach[k] <= start:
            free.append((kind, start, end))
    return free


def scope_ends(text: str) -> np.ndarray:
    """Positions at which a scope ends, the end of the text last."""
    return np.array([m.start() for m in _BLANK_LINE.finditer(text)] + [len(text)])


def interval_join(start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each span the number of an interval that it touches and that reaches furthest, or -1."""
    if not len(low):
        return np.full(len(start), -1)
    order = np.argsort(low, kind="stable")
    reach = np.maximum.accumulate(high[order])
    furthest = np.maximum.accumulate(np.where(high[order] == reach, np.arange(len(order)), 0))
    at = np.searchsorted(low[order], end, side="right") - 1
    hit = (at >= 0) & (reach[at] >= start)
    return np.where(hit, order[furthest[at]], -1)


def _scan(texts: pa.Array, reach: int) -> pa.Array:
    kind, start, end, row, low, high = [], [], [], [], [], []
    place = 0  # texts of the batch lie one after another, so one join serves them all
    bases = []
    for k, text in enumerate(texts.to_pylist()):
        text = text or ""
        base = base_parts(text)
        bases.append(place)
        weak = weak_parts(text, base)
        ends = scope_ends(text) if weak else None
        for part in base + weak:
            kind.append(part[0])
            start.append(place + part[1])
            end.append(place + part[2])
            row.append(k)
            scope = int(np.searchsorted(ends, part[1])) if weak else 0
            low.append(place + max(part[1] - reach, int(ends[scope - 1]) + 1 if weak and scope else 0))
            high.append(place + min(part[2] + reach, int(ends[scope])) if weak else place + part[2])
        place += len(text) + 1
    kind, start, end, row, low, high = (np.array(x, np.int64) for x in (kind, start, end, row, low, high))
    partner = np.full(len(kind), -1)
    names, secrets = np.flatnonzero((kind == 1) | (kind == 3)), np.flatnonzero(kind == 4)
    # A strong secret completes a weak identifier too.
    strong = np.flatnonzero((kind == 0) | (kind == 2) | (kind == 4))
    found = interval_join(start[secrets], end[secrets], low[names], high[names])
    partner[secrets] = np.where(found >= 0, start[names[found]] if len(names) else -1, -1)
    weak_names = np.flatnonzero(kind == 3)
    found = interval_join(start[weak_names], end[weak_names], low[strong], high[strong])
    partner[weak_names] = np.where(found >= 0, start[strong[found]] if len(strong) else -1, -1)
    points = np.flatnonzero(kind == 5)
    near_name = interval_join(start[points], end[points], low[names], high[names])
    near_secret = interval_join(start[points], end[points], low[strong], high[strong])
    both = (near_name >= 0) & (near_secret >= 0)
    partner[points] = np.where(both, start[names[near_name]] if len(names) else -1, -1)
    kept = np.flatnonzero((kind < 3) | (partner >= 0))
    kept = kept[np.lexsort((end[kept], kind[kept], start[kept]))]
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for i in kept.tolist():
        base = bases[row[i]]
        out[row[i]].append(
            {"kind": KINDS[kind[i]], "start": int(start[i]) - base, "end": int(end[i]) - base, "partner": int(partner[i]) - base if partner[i] >= 0 else None}
        )
    return pa.array(out, pa.list_(_SPAN))


def with_spans(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """Adds ``secrets``: spans (kind, start, end, partner) in code points, by start, then kind.

    ``partner`` is the start of the part that a weak span was linked to.
    """
    scan = F.arrow_udf(lambda texts: _scan(texts, reach), _SPANS).asNondeterministic()
    return docs.withColumn("secrets", scan(F.col(text)))


def masked(scanned: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """Puts a mask in the place of every reported span; endpoints and identifiers stay readable."""
    hidden = of_kinds("assign", "access", "hex", "secret")

    def cut(so_far: Column, span: Column) -> Column:
        # from left to right: the text before the span is copied once, overlapping spans give one mask
        begin = F.greatest(span["start"], so_far["at"])
        fresh = span["start"] >= so_far["at"]
        return F.struct(
            F.when(fresh, F.concat(so_far["out"], F.substring(F.col(text), so_far["at"] + 1, begin - so_far["at"]), F.lit(mask))).otherwise(so_far["out"]).alias("out"),
            F.greatest(span["end"], so_far["at"]).alias("at"),
        )

    rest = F.aggregate(hidden, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), cut)
    whole = F.concat(rest["out"], F.substring(F.col(text), rest["at"] + 1, F.length(text)))
    return scanned.withColumn(text, F.when(F.size(hidden) > 0, whole).otherwise(F.col(text)))


def of_kinds(*kinds: str) -> Column:
    return F.filter("secrets", lambda s: s["kind"].isin(*kinds))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secret_links(spark, sf_dir: str) -> DataFrame:
    found = with_spans(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [F.size(of_kinds(k)).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    base = of_kinds(*BASE_KINDS)
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))
