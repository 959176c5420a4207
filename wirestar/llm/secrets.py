"""Secrets in texts, told from widely copied examples by who else has them.

Patterns find candidates with their spans. Each candidate's value is hashed, and for each hash
the whole corpus is asked in how many repositories and with how many owners it stands. An
example that many owners have copied is public; a value that one owner alone has looks live.
Copies of one text (case and white space aside) count once, for the repository and owner of the
least id; an example needs ``EXAMPLE_OWNERS`` owners and as many repositories. All spans are
reported with their verdict.

All work is column expressions. Spans count code points, end exclusive. Positions come from
cutting the text at the matches: lengths of what lies between and of the matches add up.

Nulls: a null text counts as empty and has no spans; a null repository or owner counts as one
of its own. Rows that repeat a document are reported as often, and count once in the corpus
counts. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirestar.llm.common import SPACES, free_name, text_or_empty, with_chance
from wirestar.sources.staging import Staging

#: A value with so many owners or more is a widely copied example.
EXAMPLE_OWNERS = 3
MASK = "[SECRET]"


@dataclass(frozen=True)
class Kind:
    """``value``: the pattern's group that holds the secret, at least ``least`` long.
    ``hint``: a cheap test that every text with a match passes."""

    name: str
    pattern: str
    value: int
    least: int
    hint: Callable[[Column], Column]
    base: bool = True


def _any_of(*words: str):
    def found(text: Column) -> Column:
        tests = [F.contains(F.lower(text), F.lit(word)) for word in words]
        return reduce(operator.or_, tests)

    return found


# The base patterns of the contract, in its order, then the added ones.
KINDS = [
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8, _any_of("passw", "secret", "token", "api"),
    ),
    Kind("access", r"(AKIA[A-Z0-9]+)", 1, 16, lambda text: F.contains(text, F.lit("AKIA"))),
    Kind("hex", r"([0-9a-f]{32,})", 1, 32, lambda text: text.rlike("[0-9a-f]{32}")),
    Kind(
        "bearer", r"(?:bearer|Bearer|BEARER)\x20+([A-Za-z0-9+/_.=-]{20,})", 1, 20,
        _any_of("bearer"), base=False,
    ),
    Kind(
        "login", r"[a-z]{2,12}://[A-Za-z0-9._-]{1,64}:([A-Za-z0-9+_.=-]{6,64})@", 1, 6,
        lambda text: F.contains(text, F.lit("://")), base=False,
    ),
    Kind(
        "prefixed", r"((?:gh[opsu]_|sk[-_]|xox[abp]-)[A-Za-z0-9_-]{16,})", 1, 20,
        lambda text: F.contains(text, F.lit("gh")) | F.contains(text, F.lit("sk"))
        | F.contains(text, F.lit("xox")), base=False,
    ),
    Kind("upper_hex", r"([0-9A-F]{32,})", 1, 32, lambda text: text.rlike("[0-9A-F]{32}"), base=False),
]

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def spans_of(text: Column, kind: Kind, number: int) -> Column:
    """All matches of ``kind`` in ``text`` as (start, kind, end, value), in order.

    The search is leftmost without overlaps; matches with too short a value are dropped after
    it. Whole matches, values and the stretches before each match line up by index.
    """
    pattern = F.lit(kind.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.value))
    gaps = F.split(text, kind.pattern, -1)
    steps = F.zip_with(
        F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m"))),
        values,
        lambda s, v: F.struct(s["gap"].alias("gap"), F.length(s["m"]).alias("n"), v.alias("v")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(state: Column, s: Column) -> Column:
        begin = state["at"] + s["gap"]
        end = begin + s["n"]
        span = F.struct(
            begin.alias("start"), F.lit(number).alias("kind"), end.alias("end"), s["v"].alias("value")
        )
        found = F.when(
            F.length(s["v"]) >= kind.least, F.concat(state["found"], F.array(span))
        ).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    steps = F.filter(steps, lambda s: s["n"].isNotNull())
    found = F.aggregate(steps, start, step, lambda state: state["found"])
    return F.when(kind.hint(text), found).otherwise(F.array().cast(_SPAN))


def candidates(
    docs: DataFrame, repository: Column, owner: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, the columns to ``keep``, repository, owner,
    all found spans, and where there are any a hash of the text without case and white space."""
    text = text_or_empty()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        *keep,
        repository.cast("string").alias("repository"),
        owner.cast("string").alias("owner"),
        text.alias("text"),
    )
    found = F.concat(*(spans_of(F.col("text"), kind, i) for i, kind in enumerate(KINDS)))
    folded = F.trim(F.lower(F.regexp_replace("text", SPACES, " ")))
    text_hash = F.when(F.size("spans") > 0, F.xxhash64(folded))
    return rows.withColumn("spans", found).withColumn("text_hash", text_hash).drop("text")


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash: in how many repositories and with how many owners it stands.
    The rows of one text are first one, that of the least id. Counted in steps, each combined
    before its shuffle, so no value's rows meet in one task."""
    value = F.explode(F.expr("array_distinct(transform(spans, s -> xxhash64(s.value)))"))
    place = (
        F.coalesce("owner", F.lit("")).alias("owner"),
        F.coalesce("repository", F.lit("")).alias("repository"),
    )
    entry = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *place)
    entries = found.select("text_hash", entry.alias("entry"), value.alias("hash"))
    entries = entries.groupBy("hash", "text_hash").agg(F.min("entry").alias("entry"))
    places = entries.select("entry.owner", "entry.repository", "hash").distinct()
    per_owner = places.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return per_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories")
    )


def scan(
    docs: DataFrame,
    staging: Staging,
    repository: Column | None = None,
    owner: Column | None = None,
    example_owners: int = EXAMPLE_OWNERS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, columns to ``keep`` and ``spans``, an array of structs with start, end,
    kind, owners, repositories and live, by start and kind. Without a ``repository`` each
    document is one; the ``owner`` is by default its source."""
    repository = F.col("doc_id") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    found = staging.write(candidates(docs, repository, owner, keep), "candidates").df
    spans = found.select("row", F.inline("spans")).withColumn("hash", F.xxhash64("value"))
    with_any = found.where(F.size("spans") > 0)
    judged = spans.join(ownership(with_any), "hash")  # AQE splits a hot value's rows
    few = [F.col(c) < example_owners for c in ("owners", "repositories")]
    live = few[0] | few[1]
    details = F.struct(
        "start", "kind", "end", "owners", "repositories", live.alias("live")
    )
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list(details)).alias("spans"))
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return (
        found.select("row", "doc_id", *keep)
        .join(per_row, "row", "left")
        .select("doc_id", *keep, F.coalesce("spans", empty).alias("spans"))
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and written spans of ``scan``'s rows."""
    names = F.array(*(F.lit(k.name) for k in KINDS))
    base = [i for i, kind in enumerate(KINDS) if kind.base]

    def written(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    def number(test) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(i: int):
        return lambda s: s["kind"] == i

    counts = [number(of_kind(i)).alias(f"n_{KINDS[i].name}") for i in base]
    basic = F.filter("spans", lambda s: s["kind"].isin(base))
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(written(basic).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        number(lambda s: s["live"]).alias("n_live"),
        number(lambda s: ~s["live"]).alias("n_example"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["owners"])), F.lit(0))
        .alias("most_owners"),
    )


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with all live spans replaced. Spans may overlap or repeat; what any of them
    covers goes, and each stretch of overlapping spans leaves one mask."""
    live = F.filter(spans, lambda s: s["live"])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        fresh = (s["start"] > state["at"]) | (F.size(state["parts"]) == 0)
        parts = F.when(fresh, F.concat(state["parts"], F.array(between, F.lit(mask))))
        at = F.greatest(state["at"], s["end"])
        return F.struct(at.alias("at"), parts.otherwise(state["parts"]).alias("parts"))

    def finish(state: Column) -> Column:
        rest = F.substring(text, state["at"] + 1, F.length(text))
        return F.concat(F.array_join(state["parts"], ""), rest)

    return F.when(F.size(live) > 0, F.aggregate(live, start, step, finish)).otherwise(text)


def mask_live(docs: DataFrame, staging: Staging) -> DataFrame:
    """All rows of ``docs`` with their columns; in their texts, secrets that look live are
    masked. Only documents with live spans are looked up; a repeated id's rows are matched by
    their texts as well."""
    sha, id_, text_, spans = (free_name(docs, n) for n in ("_sha", "_id", "_text", "_spans"))
    rows = docs.withColumn(sha, F.sha2(text_or_empty().cast("binary"), 256))
    scanned = scan(rows, staging, keep=[sha])
    live = scanned.where(F.exists("spans", lambda s: s["live"]))
    live = live.select(
        F.col("doc_id").alias(id_), F.col(sha).alias(text_), F.col("spans").alias(spans)
    )
    live = staging.write(live.dropDuplicates([id_, text_]), "live")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(sha) == F.col(text_))
    chance = free_name(docs, "_chance")
    rows = with_chance(rows, sha, live.df.select(text_), live.rows, chance)
    found = rows.where(chance).join(live.df, same, "left")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col(spans)))
    found = found.withColumn("text", text).select(*docs.columns)
    return rows.where(~F.col(chance)).select(*docs.columns).unionByName(found)
