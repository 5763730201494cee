"""Secret scan: base patterns, and weak credential parts that only count together.

A credential often comes in parts: who (an access identifier), what (a secret) and where
(an endpoint). A part that is weak by itself, such as a user name or a short password, is
reported only when the parts that complete it stand within the same scope, ``scope`` code
points away at most in the same document. Built-in functions only: no Python on executors.

* Spans come from cutting a text at the matches: lengths of pieces and matches, summed up
  by a window over one text's matches, are positions in code points.
* Linking is an equi-join on (row, scope bucket) with an overlap condition. Spans of a kind
  do not overlap and have a least length, so a bucket holds at most ``scope`` of them: the
  join's output is bounded per span however many rows or copies there are.

NULL and empty texts have no spans. Rows are told apart by a number of their own, so repeated
ids and rows each give a row. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from txnmart.llm.common import apart
from txnmart.scratch import staged, temporary


def either_case(words: str) -> str:
    """A pattern for ``words`` in which every ASCII letter may have either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""

# The base kinds in their order, with the least length of their last group.
ASSIGN = f"({either_case('password|passwd|secret|token|api_?key')}){_GIVEN}([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

# The weak kinds: a named identifier, a short assigned secret, a long mixed run, an address.
IDENT = (
    f"({either_case('username|user_?id|user|login|account_?id|client_?id|key_?id')})"
    f"{_GIVEN}([A-Za-z0-9@._-]+)"
)
BLOB = r"[A-Za-z0-9+/_-]{32,}"
ENDPOINT = r"""(?:https?|ftps?|s3|ssh|jdbc:[a-z]+|postgresql|postgres|mysql|mongodb|redis|amqps?|ldaps?)://[^\x20\x09-\x0D"'<>]+"""

IDENTIFIER, SECRET, PLACE = "identifier", "secret", "endpoint"


@dataclass(frozen=True)
class Kind:
    """A span's kind: its rank among kinds, its role in a credential, whether it is reported
    by itself, its pattern, and the lengths its ``group`` may have. ``mixed`` asks for a
    lower-case letter, a capital and a digit."""

    name: str
    rank: int
    role: str
    strong: bool
    pattern: str
    group: int = 0
    least: int = 0
    most: int = 1 << 30
    mixed: bool = False


KINDS = (
    Kind("assign", 0, SECRET, True, ASSIGN, group=2, least=12),
    Kind("access", 1, IDENTIFIER, True, ACCESS),
    Kind("hex", 2, SECRET, True, HEX),
    Kind("ident", 3, IDENTIFIER, False, IDENT, group=2, least=3),
    Kind("short", 4, SECRET, False, ASSIGN, group=2, least=6, most=11),
    Kind("blob", 5, SECRET, False, BLOB, mixed=True),
    Kind("endpoint", 6, PLACE, False, ENDPOINT),
)
SCOPE = 200


def _found(text: Column, kind: Kind) -> Column:
    """Every match: the code points before it since the last one, its length, and whether
    it passes; NULL without any."""
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    passes = F.transform(
        part,
        lambda m: F.length(m).between(kind.least, kind.most)
        & (m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]") if kind.mixed else F.lit(True)),
    )
    each = F.arrays_zip(
        gaps.alias("gap"), F.transform(whole, F.length).alias("len"), passes.alias("ok")
    )
    # arrays_zip pads: the last gap has no match.
    matches = F.filter(each, lambda m: m["len"].isNotNull())
    return F.when(text.rlike(kind.pattern), F.struct(F.lit(kind.rank).alias("rank"), matches.alias("m")))


def find_parts(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> tuple[DataFrame, DataFrame]:
    """The rows, numbered, and their spans of all kinds, weak ones too.

    Returns (``row``, ``doc_id``) and (``row``, ``rank``, ``start``, ``end``). Texts are read
    once; what is found is written to the scratch folder."""
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.array_compact(F.array(*[_found(text, k) for k in kinds])).alias("found"),
        ),
        "secret-parts",
    )
    runs = seen.select("row", F.explode("found").alias("f")).select(
        "row", F.col("f.rank").alias("rank"), F.posexplode("f.m").alias("nth", "m")
    )
    before = Window.partitionBy("row", "rank").orderBy("nth")
    end = F.sum(F.col("m.gap") + F.col("m.len")).over(before)
    spans = runs.select(
        "row", "rank", (end - F.col("m.len")).alias("start"), end.alias("end"), "m.ok"
    )
    return seen.select("row", "doc_id"), spans.where("ok").drop("ok")


def _roles(rank: Column, kinds: tuple[Kind, ...]) -> tuple[Column, Column]:
    role = F.element_at(F.array(*[F.lit(k.role) for k in kinds]), rank + 1)
    strong = F.element_at(F.array(*[F.lit(k.strong) for k in kinds]), rank + 1)
    return role, strong


def link_parts(spans: DataFrame, kinds: tuple[Kind, ...] = KINDS, scope: int = SCOPE) -> DataFrame:
    """The strong spans, and the weak ones whose other parts stand within ``scope``.

    A weak span that overlaps a strong one adds nothing and goes. A weak identifier needs a
    strong secret, or a weak one and an endpoint; a weak secret an identifier likewise; an
    endpoint needs an identifier and a secret."""
    role, strong = _roles(F.col("rank"), kinds)
    parts = spans.withColumns({"role": role, "strong": strong})
    weak = parts.where(~F.col("strong"))

    def buckets(reach: int) -> Column:
        first = F.floor((F.greatest(F.col("start") - reach, F.lit(0))) / scope)
        return F.sequence(first, F.floor((F.col("end") + reach) / scope))

    near = parts.select(
        F.col("row").alias("o_row"),
        F.col("rank").alias("o_rank"),
        F.col("start").alias("o_start"),
        F.col("end").alias("o_end"),
        F.col("role").alias("o_role"),
        F.col("strong").alias("o_strong"),
        F.explode(buckets(0)).alias("o_bucket"),
    )
    pairs = weak.withColumn("bucket", F.explode(buckets(scope))).join(
        near,
        (F.col("row") == F.col("o_row"))
        & (F.col("bucket") == F.col("o_bucket"))
        & (F.col("o_start") <= F.col("end") + scope)
        & (F.col("start") <= F.col("o_end") + scope),
    )
    apart = (F.col("o_end") <= F.col("start")) | (F.col("end") <= F.col("o_start"))

    def some(condition: Column) -> Column:
        return F.coalesce(F.max(condition), F.lit(False))

    def other(name: str, sure: bool) -> Column:
        return some(apart & (F.col("o_role") == name) & (F.col("o_strong") | F.lit(not sure)))

    seen = pairs.groupBy("row", "rank", "start", "end", "role").agg(
        some(~apart & F.col("o_strong")).alias("covered"),
        other(IDENTIFIER, True).alias("sure_id"),
        other(IDENTIFIER, False).alias("any_id"),
        other(SECRET, True).alias("sure_secret"),
        other(SECRET, False).alias("any_secret"),
        other(PLACE, False).alias("place"),
    )
    linked = seen.where(
        ~F.col("covered")
        & F.when(F.col("role") == IDENTIFIER, F.expr("sure_secret or (any_secret and place)"))
        .when(F.col("role") == SECRET, F.expr("sure_id or (any_id and place)"))
        .otherwise(F.expr("any_id and any_secret"))
    )
    columns = ["row", "rank", "start", "end"]
    return parts.where("strong").select(*columns).unionByName(linked.select(*columns))


def scan_secrets(
    docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, scope: int = SCOPE
) -> DataFrame:
    """One row per document row: ``doc_id`` and its ``spans``, an array of (start, rank, kind,
    end) in that order, positions in code points."""
    rows, found = find_parts(docs, kinds)
    name = F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("rank") + 1)
    by_row = (
        link_parts(found, kinds, scope)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "rank", name.alias("kind"), "end"))).alias("spans"))
    )
    none = F.from_json(F.lit("[]"), T.ArrayType(by_row.schema["spans"].dataType.elementType))
    return rows.join(by_row, "row", "left").select(
        "row", "doc_id", F.coalesce("spans", none).alias("spans")
    )


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of every document's spans."""
    scanned = scan_secrets(docs)
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < 3)

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; other columns stay, ``n_chars``
    follows the text where there is one. A text without spans is left as it is, NULL too."""
    own = apart(docs, "_secret")
    row, of, found, new = (f"{own}_{n}" for n in ("row", "of", "spans", "text"))
    held = staged(docs.withColumn(row, F.monotonically_increasing_id()), "redact")
    numbered = held.select(F.col(row).alias("doc_id"), "text")
    with temporary(docs.sparkSession) as block:
        marks = scan_secrets(numbered).where(F.size("spans") > 0)
        marks = marks.select(F.col("doc_id").alias(of), F.col("spans").alias(found))
        marks = block.keep(staged(marks, "redact-spans"))
    # Walk the spans in order; one that begins inside the last masked stretch adds to it.
    text = F.col("text")
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        masked = F.concat(acc["done"], between, F.lit(mask))
        return F.when(
            s["start"] >= acc["at"], F.struct(masked.alias("done"), s["end"].alias("at"))
        ).otherwise(
            F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))
        )

    walked = F.aggregate(found, start, step)
    rest = F.substring(text, walked["at"].cast("int") + 1, F.length(text))
    out = held.join(marks, F.col(row) == F.col(of), "left").withColumn(
        new,
        F.when(F.col(found).isNotNull(), F.concat(walked["done"], rest)),
    )
    changed = {"text": F.coalesce(new, text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(
            F.col(new).isNotNull(), F.length(new).cast("long")
        ).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
