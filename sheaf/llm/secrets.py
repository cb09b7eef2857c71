r"""Secret scans with multipart credential linking, in DataFrame functions alone.

Base spans are leftmost, non-overlapping matches of three kinds (assign, access,
hex); matches that are too short are dropped after matching. A match's place is
found by cutting the text at the pattern: the lengths of the pieces and of the
matches between them add up to code points.

The method then looks for weak parts, which are reported only where they
complete a credential: identifiers (user or client names, further access ids),
secrets (40 characters of mixed case and digits, short passwords) and endpoints
(URLs, host assignments). Parts are joined by interval within a scope: the text
is laid out in buckets as wide as the scope, a part is entered in every bucket
that it reaches, and two are linked where the gap between them is at most the
scope. A weak identifier or endpoint needs a secret in its
scope; a weak secret needs an identifier or endpoint. Base spans count as
strong parts of their kinds and stay, whatever is around them.

Defined results: null and empty texts have no spans; rows that repeat are
reported each; a null id is kept; an empty table gives no rows. Extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import materialize

#: The base patterns. The long forms of access and hex match what
#: the short ones do after matches under 20 and 24 characters are dropped.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak parts: kind, what it completes, pattern.
WEAK = (
    ("wid", "id", r"""(?i:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}"""),
    ("wkey", "secret", r"""[A-Za-z0-9+/]{40,}+"""),
    ("wpass", "secret", r"""(?i:pass|pwd|private_?key|auth)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=@!-]{6,}"""),
    ("wend", "endpoint", r"""(?i:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._:@/%-]+|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:-]{4,}"""),
)
#: What a base kind counts as, and the order of kinds at one start.
BASE = {"assign": "secret", "access": "id", "hex": "secret"}
ORDER = ("assign", "access", "hex", "wid", "wkey", "wpass", "wend")
SCOPE = 300

_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,piece:string>>"


def spans(text: Column, kind: str, pattern: str) -> Column:
    """All matches of a pattern as structs of start, rank, end, kind and matched text."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rank = ORDER.index(kind)

    def step(state: Column, pair: Column) -> Column:
        start = (state["at"] + F.length(pair["piece"])).cast("int")
        end = (start + F.length(pair["hit"])).cast("int")
        hit = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), pair["hit"].alias("piece"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(hit)).alias("out"))

    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda piece, hit: F.struct(piece.alias("piece"), hit.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    all_ = F.aggregate(pairs, start, step, lambda s: s["out"])
    return F.when(text.rlike(pattern), all_).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> dict[str, Column]:
    """The base spans of each kind; failing matches are gone."""
    assigned = F.filter(spans(text, "assign", ASSIGN), lambda s: F.length(F.regexp_extract(s["piece"], ASSIGN, 2)) >= 6)
    return {"assign": assigned, "access": spans(text, "access", ACCESS), "hex": spans(text, "hex", HEX)}


def listed(array: Column) -> Column:
    """kind:start:end of spans by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(array), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def role_of(kind: Column) -> Column:
    roles = BASE | {k: r for k, r, _ in WEAK}
    return F.element_at(F.create_map(*(F.lit(v) for kv in roles.items() for v in kv)), kind)


def weak_spans(text: Column) -> Column:
    """Weak candidates: keys are 40 characters long and mix cases and digits."""
    every = F.concat(*(spans(text, kind, pattern) for kind, _, pattern in WEAK))
    mixed = lambda s: (F.length(s["piece"]) == 40) & s["piece"].rlike("[a-z]") & s["piece"].rlike("[A-Z]") & s["piece"].rlike("[0-9]")
    return F.filter(every, lambda s: (s["kind"] != "wkey") | mixed(s))


def completed(parts: DataFrame, key: str, scope: int) -> DataFrame:
    """key and the weak spans (added) that a complementary part completes within the scope.

    parts: key and all spans of a text. A span reaches the scope to both sides
    and is entered in every bucket it reaches; what meets in a bucket is bounded
    by the bucket's width, and a text with very many parts has many buckets.
    """
    each = parts.select(key, F.explode("parts").alias("s")).withColumn("role", role_of(F.col("s.kind")))
    reach = F.sequence(F.floor(F.greatest(F.col("s.start") - scope, F.lit(0)) / scope), F.floor((F.col("s.end") + scope) / scope))
    held = each.select(F.col(key).alias("o_key"), F.explode(reach).alias("o_bucket"), F.col("s.start").alias("o_start"), F.col("s.end").alias("o_end"), F.col("role").alias("o_role"))
    own = F.sequence(F.floor(F.col("s.start") / scope), F.floor(F.col("s.end") / scope))
    asked = each.filter(F.col("s.kind").startswith("w")).select(key, F.explode(own).alias("bucket"), "s", "role")
    complement = (F.col("role") == "secret") != (F.col("o_role") == "secret")
    gap = F.greatest(F.col("s.start") - F.col("o_end"), F.col("o_start") - F.col("s.end"))
    met = asked.join(held, (F.col(key) == F.col("o_key")) & (F.col("bucket") == F.col("o_bucket")) & complement & (gap <= scope), "left_semi")
    return met.select(key, "s").distinct().groupBy(key).agg(F.array_sort(F.collect_list("s")).alias("added"))


def may_gain(base: Column, weak: Column) -> Column:
    """Whether a text has a weak part, and parts of both sides."""
    roles = F.transform(F.concat(base, weak), lambda s: role_of(s["kind"]))
    return (F.size(weak) > 0) & F.array_contains(roles, "secret") & (F.array_contains(roles, "id") | F.array_contains(roles, "endpoint"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, counts, base_sha256 and spans of every row.

    The texts are read once: what is found in them is written, each row under a
    number of its own, and the linking works on that.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", *(c.alias(k) for k, c in base_spans(text).items()), weak_spans(text).alias("weak"))
    found = materialize(found, "secret-spans")
    base = F.concat("assign", "access", "hex")
    added = completed(found.filter(may_gain(base, F.col("weak"))).select("row", F.concat(base, "weak").alias("parts")), "row", scope)
    every = F.concat(base, F.coalesce("added", F.array().cast(_SPANS)))
    return found.join(added, "row", "left").select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(every).alias("spans"),
    )


def masked(docs: DataFrame, mark: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """docs with a mark in place of every span, all columns kept; n_chars, if there, follows the text.

    Spans that overlap become one mark. The texts are written once beside their
    spans; weak spans are linked by the interval join of ``scan``, and only the
    texts that can gain one are joined with it, so all others stay where they
    are. Texts without a span, null and empty ones stay as they are; repeated
    rows are each masked; an empty table gives no rows.
    """
    row, base, weak = (_free(docs, n) for n in ("_secret_row", "_secret_base", "_secret_weak"))
    own = F.coalesce("text", F.lit(""))
    held = docs.withColumns({row: F.monotonically_increasing_id(), base: F.concat(*base_spans(own).values()), weak: weak_spans(own)})
    held = materialize(held, "secret-texts")
    gains = may_gain(F.col(base), F.col(weak))
    linked = completed(held.filter(gains).select(F.col(row).alias("row"), F.concat(base, weak).alias("parts")), "row", scope)
    joined = held.filter(gains).join(linked, F.col(row) == F.col("row"), "left").withColumn(base, F.concat(base, F.coalesce("added", F.array().cast(_SPANS)))).select(held.columns)
    every = held.filter(~gains).unionByName(joined)

    def step(state: Column, s: Column) -> Column:
        before = F.substring("text", state["at"] + 1, s["start"] - state["at"])
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rewritten = F.aggregate(F.array_sort(base), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring("text", s["at"] + 1, F.length("text"))))
    kept = every.withColumn("text", F.when(F.size(base) > 0, rewritten).otherwise(F.col("text"))).select(docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    while name in docs.columns:
        name += "_"
    return name
