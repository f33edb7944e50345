"""Secret scans with corpus-wide ownership frequency.

Every text is scanned for candidates: values assigned to a secret's name, access keys, long hex
strings (the base kinds), and tokens that look random (kind ``token``). A candidate is known by the
SHA-256 of its value. Over the whole corpus each hash is counted by distinct repositories and
distinct owners. A value that more than ``max_owners`` owners or more than ``max_repositories``
repositories hold is an example that people copy; any other looks like a live credential of its
owners. Base spans are always reported; the method adds the ``token`` spans that look live.

Offsets are code points, the end is exclusive. A null text counts as empty, a null owner or
repository as one further value. Repeated rows are scanned and reported each.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcurve.llm.common import free_name, hex_digest, map_batches, texts
from shelfcurve.operators.joins import join_group_stats
from shelfcurve.session import materialise

# fixed values: the names and forms of a secret
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "token")
NAMES = ("passw", "secret", "token", "api")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
TOKEN_BITS = 3.5
MAX_OWNERS = 2
MAX_REPOSITORIES = 50


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base kinds, leftmost and non-overlapping within a kind."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(*m.span(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(*m.span(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(*m.span(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def looks_random(value: str) -> bool:
    """Letters and digits mixed, and at least ``TOKEN_BITS`` bits of entropy a character."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= TOKEN_BITS


def token_spans(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Tokens that look random and overlap no base span."""
    return [
        (*m.span(), "token", m[0])
        for m in TOKEN.finditer(text)
        if looks_random(m[0]) and not any(s[0] < m.end() and m.start() < s[1] for s in taken)
    ]


def joined(spans: list[tuple[int, int, str, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


_CANDIDATE = "struct<start:bigint,value:bigint,end:bigint,kind:string,hash:string>"  # value: where the value starts
_SCANNED = f"n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, candidates array<{_CANDIDATE}>"


def _scanned(found: list[str]) -> pa.Array:
    """For each text its counts by kind, base_sha256 and candidates, as a struct."""
    rows = []
    for text in found:
        base = base_spans(text)
        kinds = Counter(s[2] for s in base)
        spans = sorted([*base, *token_spans(text, base)], key=lambda s: (s[0], KINDS.index(s[2])))
        rows.append(
            {
                "n_assign": kinds["assign"], "n_access": kinds["access"], "n_hex": kinds["hex"],
                "base_sha256": hex_digest(joined(base).encode()),
                "candidates": [
                    {"start": a, "value": b - len(v), "end": b, "kind": kind, "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()}
                    for a, b, kind, v in spans
                ],
            }
        )
    item = pa.struct([("start", pa.int64()), ("value", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("hash", pa.string())])
    counts = [(name, pa.int64()) for name in ("n_assign", "n_access", "n_hex")]
    return pa.array(rows, pa.struct([*counts, ("base_sha256", pa.string()), ("candidates", pa.list_(item))]))


def scan(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` of each row with ``scanned``: its counts by kind, base_sha256 and its candidates."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _scanned(texts(batch, len(keys)))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keys))), found], [*keys, "scanned"])

    picked = docs.select(*keys, F.col(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[: len(keys)])
    return map_batches(picked, run, f"{fields}, scanned struct<{_SCANNED.replace(' ', ':').replace(',:', ', ')}>")


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, repositories, owners): distinct values of ``repository`` and ``owner`` for each hash.

    ``candidates`` has (hash, repository, owner). Pairs are made distinct first, with partial sums
    before every shuffle, so that a value which a third of all rows hold does not load one task.
    """
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))  # noqa: E731  a null is a value of its own
    pairs = candidates.select("hash", some("repository").alias("repository"), some("owner").alias("owner")).distinct()
    repositories = pairs.select("hash", "repository").distinct().groupBy("hash").agg(F.count("*").alias("repositories"))
    owners = pairs.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    return repositories.join(owners, "hash")


def is_live(max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> Column:
    return (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)


def _judged(each: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """Candidates with the counts of their value and ``live``; a value of very many rows is dealt over tasks."""
    counts = materialise(ownership(each), "ownership")
    return join_group_stats(each, counts, ["hash"]).withColumn("live", is_live(max_owners, max_repositories))


def find_secrets(
    docs: DataFrame, repository: str = "doc_id", owner: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_token,
    n_live, n_copied, repositories, owners.

    ``spans`` are the base spans and the token spans that look live, as kind:start:end by start; they
    cover the whole match. ``n_live`` and ``n_copied`` count all candidates; ``repositories`` and
    ``owners`` are the greatest counts of a candidate of the row, 0 without one. Texts are read once;
    what is stored between the steps are candidates, not texts.
    """
    named = docs.select("doc_id", F.col(repository).alias("repository"), F.col(owner).alias("owner"), "text")
    keys = ["doc_id", "repository", "owner"]
    scanned = materialise(scan(named, keys).select(*keys, "scanned.*", F.monotonically_increasing_id().alias("row")), "secrets")
    each = scanned.select("row", "repository", "owner", F.explode("candidates").alias("c")).select("row", "repository", "owner", "c.*")
    judged = _judged(each, max_owners, max_repositories)
    span = F.struct("start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("place"), "end", "kind", "live")
    by_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(span)).alias("all"), F.max("repositories").alias("repositories"), F.max("owners").alias("owners")
    )
    told = scanned.drop("repository", "owner").join(by_row, "row", "left")
    none = F.expr("cast(array() as array<struct<start:bigint,place:bigint,end:bigint,kind:string,live:boolean>>)")
    told = told.withColumn("all", F.coalesce("all", none))
    shown = F.filter("all", lambda s: (s["kind"] != "token") | s["live"])
    return told.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(F.transform(shown, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",").alias("spans"),
        F.size(F.filter("all", lambda s: (s["kind"] == "token") & s["live"])).cast("bigint").alias("n_token"),
        F.size(F.filter("all", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("all", lambda s: ~s["live"])).cast("bigint").alias("n_copied"),
        F.coalesce("repositories", F.lit(0)).alias("repositories"), F.coalesce("owners", F.lit(0)).alias("owners"),
    )


def redact(
    docs: DataFrame, repository: str = "doc_id", owner: str = "source", max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES, mark: str = "<secret>",
) -> DataFrame:
    """``docs`` with the value of every live-looking candidate replaced by ``mark``; rows and columns stay.

    The name that a value is assigned to stays, as do values that are widely copied. ``n_chars``, if
    there, follows the new text; a null stays null. Overlapping values are replaced once, together.
    Repeated rows are treated alike, and other columns may have any names. Only rows with a candidate
    are joined, by a number of their own; all others go on as they are.
    """
    names, helper = docs.columns, free_name(docs)

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _scanned(texts(batch)).field("candidates")
        return pa.RecordBatch.from_arrays([*batch.columns, found], [*names, helper])

    spans = f"array<{_CANDIDATE}>"
    stored = map_batches(docs, look, f"{docs._jdf.schema().toDDL()}, `{helper}` {spans}")
    number = free_name(stored, "row")
    stored = materialise(stored.withColumn(number, F.monotonically_increasing_id()), "scanned")
    clean, dirty = stored.where(F.size(helper) == 0).select(*names), stored.where(F.size(helper) > 0)
    each = dirty.select(F.col(number).alias("row"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.explode(helper).alias("c"))
    judged = _judged(materialise(each.select("row", "repository", "owner", "c.*"), "candidates"), max_owners, max_repositories)
    holes = judged.where("live").groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("value").alias("start"), "end"))).alias("holes"))
    marked = dirty.drop(helper).join(holes.withColumnsRenamed({"row": number, "holes": helper}), number, "left").select(*names, helper)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = batch.column(helper).to_pylist()
        new = [t if h is None else _cut(t, h, mark) for t, h in zip(batch.column("text").to_pylist(), found)]
        columns = {c: batch.column(c) for c in names}
        columns["text"] = pa.array(new, batch.schema.field("text").type)
        if "n_chars" in columns:
            sizes = [n if h is None else len(t) for n, h, t in zip(columns["n_chars"].to_pylist(), found, new)]
            columns["n_chars"] = pa.array(sizes, batch.schema.field("n_chars").type)
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return clean.unionByName(map_batches(marked, cut, docs.schema))


def _cut(text: str, holes: list[dict], mark: str) -> str:
    """``text`` with each run of overlapping holes, sorted by start, replaced by ``mark``."""
    out, at = [], 0
    for h in holes:
        if h["start"] >= at:
            out += [text[at : h["start"]], mark]
        at = max(at, h["end"])
    return "".join(out) + text[at:]
