"""Secret scans with multipart credential linking, in DataFrame functions only.

Three kinds are reported wherever they match: assignments of secrets, access identifiers
and long hexadecimal runs. Three weaker kinds are reported only as parts of a credential:

* ``key_id``, an assigned user or key name, near a secret;
* ``blob``, a bare run of 40 or more mixed base64 characters, near an access identifier;
* ``endpoint``, a service address, near both.

Near means that two parts start at most ``REACH`` code points apart. The parts of a text
are laid on stretches of that length; each stretch is reduced to the first and last start
of every role, and a weak part asks its own stretch and the two beside it. So the interval
join grows with the number of parts, however many fall into one scope, and no pairs are
made.

Positions count code points. They come from the lengths of what a pattern matches and of
what it leaves between its matches.

A null text is an empty one. Repeated rows are reported each. An empty table gives an
empty result. Documents are told apart by two 64-bit hashes of id and text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.sources.workspace import materialize

REACH = 400


@dataclass(frozen=True)
class Kind:
    """``least``: characters that ``group`` of a match must have. ``needs``: the roles a
    weak part must have beside it; without any, every match counts."""

    name: str
    role: str
    pattern: str
    group: int = 0
    least: int = 1
    holds: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()


# The three base kinds, and the order in which kinds are listed.
BASE = (
    Kind(
        "assign",
        "secret",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Kind("access", "access", r"AKIA[A-Z0-9]+", least=16),
    Kind("hex", "secret", r"[0-9a-f]{32,}", least=32),
)
WEAK = (
    Kind(
        "key_id",
        "access",
        r"""(?i)(access_?key_?id|client_?id|user_?name|login|account_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]+)""",
        group=2,
        least=3,
        needs=("secret",),
    ),
    Kind(
        "blob",
        "secret",
        r"[A-Za-z0-9+/]{40,}",
        least=40,
        holds=("[A-Z]", "[a-z]", "[0-9]"),
        needs=("access",),
    ),
    Kind(
        "endpoint",
        "endpoint",
        r"""(?i)(https?|sftp|s3|postgresql|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+""",
        needs=("access", "secret"),
    ),
)
KINDS = BASE + WEAK
_KEY = ["key", "key2"]
# ``first`` and ``last`` are the bytes of the text that ``start`` and ``stop`` stand at.
_PART = "struct<start:int,listed:int,stop:int,kind:string,first:int,last:int>"

# Running sums over an array are made for so many entries at a time, then over the groups: an
# array that grows entry by entry is copied each time.
_GROUP = 64


def _grouped(items: Column) -> Column:
    """An array as an array of arrays of ``_GROUP`` entries."""
    last = F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / _GROUP).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda n: F.slice(items, n * _GROUP + 1, _GROUP))


def _steps(text: Column, kind: Kind) -> Column:
    """Per match of one kind the lengths of the gap before it and of itself, in characters and
    bytes, and whether it counts."""
    pattern = F.lit(kind.pattern)
    gaps = F.split(text, kind.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    asked = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else whole

    def sizes(gap: Column, match: Column) -> Column:
        enough = F.length(match) >= kind.least if not kind.group else F.lit(True)
        for held in kind.holds:
            enough &= match.rlike(held)
        return F.struct(
            F.length(gap).alias("gap"),
            F.length(match).alias("size"),
            F.octet_length(gap).alias("gap_bytes"),
            F.octet_length(match).alias("bytes"),
            enough.alias("good"),
        )

    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), whole, sizes)
    if kind.group:
        steps = F.zip_with(
            steps, asked, lambda step, value: step.withField("good", step["good"] & (F.length(value) >= kind.least))
        )
    return F.when(text.rlike(kind.pattern), steps)


def _relative(steps: Column, kind: Kind, listed: int) -> Column:
    """Per group of matches its parts, counted from the group's start, and its length."""

    def advance(state: Column, step: Column) -> Column:
        start, first = state["at"] + step["gap"], state["byte"] + step["gap_bytes"]
        part = F.struct(
            start.alias("start"),
            F.lit(listed).alias("listed"),
            (start + step["size"]).alias("stop"),
            F.lit(kind.name).alias("kind"),
            first.alias("first"),
            (first + step["bytes"]).alias("last"),
        ).cast(_PART)
        return F.struct(
            (start + step["size"]).alias("at"),
            (first + step["bytes"]).alias("byte"),
            F.when(step["good"], F.concat(state["parts"], F.array(part)))
            .otherwise(state["parts"])
            .alias("parts"),
        )

    none = F.array().cast(f"array<{_PART}>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("byte"), none.alias("parts"))
    return F.transform(_grouped(steps), lambda group: F.aggregate(group, start, advance))


def _absolute(groups: Column) -> Column:
    """The parts of all groups, counted from the start of the text."""
    zero = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("byte")))

    def add(before: Column, group: Column) -> Column:
        last = F.element_at(before, -1)
        more = F.struct((last["at"] + group["at"]).alias("at"), (last["byte"] + group["byte"]).alias("byte"))
        return F.concat(before, F.array(more))

    def moved(group: Column, by: Column) -> Column:
        def move(part: Column) -> Column:
            return F.struct(
                (part["start"] + by["at"]).alias("start"),
                part["listed"].alias("listed"),
                (part["stop"] + by["at"]).alias("stop"),
                part["kind"].alias("kind"),
                (part["first"] + by["byte"]).alias("first"),
                (part["last"] + by["byte"]).alias("last"),
            )

        return F.transform(group["parts"], move)

    starts = F.slice(F.aggregate(groups, zero, add), F.lit(1), F.size(groups))
    return F.flatten(F.zip_with(groups, starts, moved)).cast(f"array<{_PART}>")


def _keyed(docs: DataFrame) -> tuple[Column, Column]:
    return (
        F.xxhash64("doc_id", "text").alias("key"),
        F.xxhash64(F.lit("second"), "text", "doc_id").alias("key2"),
    )


def _parts(docs: DataFrame) -> DataFrame:
    """Per document its keys, id and all its parts, written once so that texts are read once.

    Each step works on columns of the one before, so that nothing is worked out per entry.
    """
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    text = F.coalesce("text", F.lit(""))
    names = [kind.name for kind in KINDS]
    kept = [*_KEY, "doc_id"]
    steps = narrow.select(*_keyed(narrow), "doc_id", *(_steps(text, kind).alias(kind.name) for kind in KINDS))
    groups = steps.select(
        *kept,
        *(
            F.when(F.col(kind.name).isNotNull(), _relative(F.col(kind.name), kind, i)).alias(kind.name)
            for i, kind in enumerate(KINDS)
        ),
    )
    none = F.array().cast(f"array<{_PART}>")
    parts = (F.when(F.col(name).isNotNull(), _absolute(F.col(name))).otherwise(none) for name in names)
    return materialize(groups.select(*kept, F.concat(*parts).alias("parts")), "secret-parts")


def _linked(found: DataFrame, reach: int) -> DataFrame:
    """Per document the weak parts that have all they need beside them."""
    roles = F.create_map(*(F.lit(x) for kind in KINDS for x in (kind.name, kind.role)))
    needs = F.create_map(
        *(x for kind in WEAK for x in (F.lit(kind.name), F.array(*map(F.lit, kind.needs))))
    )
    weak = F.array(*(F.lit(kind.name) for kind in WEAK))
    lonely = F.exists("parts", lambda part: F.array_contains(weak, part["kind"]))
    parts = found.where(lonely).select(*_KEY, F.explode("parts").alias("part"))
    stretch = F.expr(f"part.start div {reach}")
    sides = parts.groupBy(
        *_KEY, F.element_at(roles, F.col("part.kind")).alias("role"), stretch.alias("stretch")
    ).agg(F.min("part.start").alias("first"), F.max("part.start").alias("last"))
    asking = (
        parts.where(F.array_contains(weak, F.col("part.kind")))
        .distinct()
        .withColumn("role", F.explode(F.element_at(needs, F.col("part.kind"))))
        .withColumn("stretch", F.explode(F.sequence(stretch - 1, stretch + 1)))
    )
    start = F.col("part.start")
    beside = asking.join(sides, [*_KEY, "role", "stretch"]).where(
        (F.col("first") <= start + reach) & (F.col("last") >= start - reach)
    )
    enough = F.size(F.element_at(needs, F.col("part.kind")))
    return (
        beside.groupBy(*_KEY, "part")
        .agg(F.size(F.collect_set("role")).alias("roles"))
        .where(F.col("roles") == enough)
        .groupBy(*_KEY)
        .agg(F.collect_list("part").alias("linked"))
    )


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per document its keys, id and ``spans``: kind, start and stop of all that is reported."""
    found = _parts(docs)
    base = F.array(*(F.lit(kind.name) for kind in BASE))
    strong = F.filter("parts", lambda part: F.array_contains(base, part["kind"]))
    linked = F.coalesce("linked", F.array().cast(f"array<{_PART}>"))
    return found.join(_linked(found, reach), _KEY, "left").select(
        *_KEY, "doc_id", F.array_sort(F.concat(strong, linked)).alias("spans")
    )


def span_list(spans: Column) -> Column:
    """``kind:start:stop``, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
    return F.array_join(F.transform(spans, one), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("bigint")


def redact_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by its kind in brackets."""
    spans = (
        find_secrets(docs, reach)
        .where(F.size("spans") > 0)
        .dropDuplicates(_KEY)
        .select(*_KEY, "spans")
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.col("text").cast("string"))
    rows = rows.select("row", F.col("text").cast("binary").alias("octets"), *_keyed(rows))
    groups = rows.join(spans.select(*_KEY, _grouped(F.col("spans")).alias("groups")), _KEY, "left")

    def furthest(at: Column, span: Column) -> Column:
        return F.greatest(at, span["last"])

    def reached(before: Column, group: Column) -> Column:
        return F.concat(before, F.array(F.aggregate(group, F.element_at(before, -1), furthest)))

    marked = groups.select(
        "row", "octets", "groups", F.aggregate("groups", F.array(F.lit(0)), reached).alias("ends")
    )

    def text_of(first: Column, size: Column) -> Column:
        return F.substring("octets", first + 1, size).cast("string")

    def cut(state: Column, span: Column) -> Column:
        # A span that begins inside an earlier one adds no mark.
        mark = F.concat(text_of(state["at"], span["first"] - state["at"]), F.lit("["), span["kind"], F.lit("]"))
        new = span["first"] >= state["at"]
        return F.struct(
            furthest(state["at"], span).alias("at"),
            F.when(new, F.concat(state["out"], F.array(mark))).otherwise(state["out"]).alias("out"),
        )

    def pieces(group: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(group, start, cut, lambda state: state["out"])

    begins = F.slice("ends", F.lit(1), F.size("groups"))
    rest = text_of(F.element_at("ends", -1), F.length("octets"))
    clean = F.concat(F.array_join(F.flatten(F.zip_with("groups", begins, pieces)), ""), rest)
    text = F.when(F.col("groups").isNull(), F.col("row.text").cast("string")).otherwise(clean)
    columns = [
        text.alias("text") if name == "text" else F.col(f"row.`{name}`") for name in docs.columns
    ]
    return marked.select(*columns)
