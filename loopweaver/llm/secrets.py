"""Secret scans: multipart credential linking, in DataFrame functions only.

Some parts are secrets by their form: assignments, access identifiers and long hex strings. Others only hint at one:
identifiers without a strict form, tokens that look random, addresses of services. A hint is reported only when its
complement stands within SCOPE code points of it in the same text: an identifier near a secret, a random token near an
identifier, an endpoint near both. That is an interval join of the hints with all parts of texts that hold a hint, on the
text and the SCOPE-wide bin, so that no bin pairs more parts than fit into it; texts themselves are never shuffled. A hint
is in all bins that it covers, a part in all bins that it comes within SCOPE of, so that every near pair shares a bin; pairs
that share several count once.

Positions are code points, ends exclusive. Matches of a kind are leftmost and don't overlap; different kinds may. Nulls
count as empty texts; empty texts have no spans. Texts with the same doc_id but different content are kept apart; repeated
rows give one row each. Texts of any length are scanned and masked whole, in time that grows with their length and parts. An
empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loopweaver.llm.chunks import BROADCAST_GROUPS
from loopweaver.llm.common import stash, table, whole_rows

SCOPE = 400
MASK = "[secret]"
#: Parts of a text that are gathered together while its matches are walked through.
BLOCK = 256
#: Code points of a chunk that masking cuts texts into.
CHUNK = 1024

# The forms of secrets, and the group and least length that count.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
STRONG = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))

# The forms of hints, with what they hint at. No pattern repeats a group, as Java matches those by recursion and
# a long text would overflow its stack: a name with dots is one run of characters, with an inner dot and without empty parts.
HINTS = (
    ("identifier", r"""(?i:access_?key(?:_?id)?|client_?id|account_?id|user_?name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}|(?<![A-Za-z0-9])AKIA[A-Z0-9]{4,15}(?![A-Za-z0-9])"""),
    ("random", r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])"),
    ("endpoint", r"(?i:https?|amqps?|postgres(?:ql)?|mysql|mongodb|redis|s3)://[^\x00-\x20\"'<>]+|(?<![A-Za-z0-9.-])(?=[A-Za-z0-9-]+\.)(?![A-Za-z0-9.-]*\.\.)[A-Za-z0-9.-]+(?<!\.):[0-9]{2,5}(?![0-9])"),
)
KINDS = tuple(x[0] for x in (*STRONG, *HINTS))
#: A cheap test that holds wherever the pattern has a match that counts.
_SIGNS = {"access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}", "random": r"[A-Za-z0-9+/]{40}", "endpoint": r"://|[A-Za-z0-9-]:[0-9]{2}"}
#: part: where it starts, rank of its kind, where it ends.
_PARTS = "array<struct<start:bigint,rank:int,end:bigint>>"


def _matches(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Parts of one kind. split() gives what lies between matches, so that running lengths give their places."""
    rank = KINDS.index(kind)
    lengths = lambda g: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(g)), F.length)
    between = F.transform(F.split(text, pattern, -1), F.length)
    each = F.arrays_zip(between.alias("gap"), lengths(0).alias("size"), lengths(group).alias("counted"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["0"]
        end = start + F.coalesce(x["1"], F.lit(0))
        part = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
        counts, full = x["2"] >= max(least, 1), F.size(acc["last"]) >= BLOCK
        # Adding a part copies the last block only, so that a text's work grows with its parts, not with their square.
        blocks = F.when(counts & full, F.concat(acc["blocks"], F.array(acc["last"]))).otherwise(acc["blocks"])
        last = F.when(counts & full, part).when(counts, F.concat(acc["last"], part)).otherwise(acc["last"])
        return F.struct(end.alias("at"), blocks.alias("blocks"), last.alias("last"))

    zipped = F.transform(each, lambda x: F.struct(*(x[i].cast("bigint").alias(str(n)) for n, i in enumerate(("gap", "size", "counted")))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{_PARTS}>").alias("blocks"), F.array().cast(_PARTS).alias("last"))
    return F.when(text.rlike(_SIGNS.get(kind, pattern)), F.aggregate(zipped, start, step, lambda acc: F.concat(F.flatten(acc["blocks"]), acc["last"]))).otherwise(F.array().cast(_PARTS))


def parts(documents: DataFrame) -> DataFrame:
    """doc_id, a key of the text, strong parts and hints of each whole text; a projection of the scan."""
    t = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return t.select("doc_id", F.xxhash64("text").alias("key"), *(_matches(F.col("text"), *k).alias(k[0]) for k in (*STRONG, *HINTS)))


def links(found: DataFrame) -> DataFrame:
    """doc_id, key and hints (array of parts) of texts in which hints have their complement."""
    strong, hints = [F.col(k[0]) for k in STRONG], [F.col(k[0]) for k in HINTS]
    some = found.where(F.size(F.concat(*hints)) > 0).dropDuplicates(["doc_id", "key"])
    here = ["doc_id", "key", "part.*"]
    # An endpoint is no complement of anything.
    near = some.select("doc_id", "key", F.explode(F.concat(*strong, *hints[:-1])).alias("part")).select(*here)
    near = near.select("doc_id", "key", F.col("start").alias("s"), F.col("end").alias("e"), F.col("rank").alias("r"), F.explode(F.sequence(F.floor((F.col("start") - SCOPE) / SCOPE), F.floor((F.col("end") + SCOPE) / SCOPE))).alias("bin"))
    hint = some.select("doc_id", "key", F.explode(F.concat(*hints)).alias("part")).select(*here).withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / SCOPE), F.floor(F.col("end") / SCOPE))))
    # <=> on doc_id: a null doc_id is a document too.
    both = hint.alias("h").join(near.alias("n"), F.expr("h.doc_id <=> n.doc_id AND h.key = n.key AND h.bin = n.bin AND n.s <= h.end + %d AND n.e >= h.start - %d AND NOT (n.s = h.start AND n.r = h.rank)" % (SCOPE, SCOPE)))
    rank = {k: i for i, k in enumerate(KINDS)}
    is_id, is_key = F.col("r").isin(rank["access"], rank["identifier"]), F.col("r").isin(rank["assign"], rank["hex"], rank["random"])
    inside = (F.col("r") < len(STRONG)) & (F.col("s") < F.col("end")) & (F.col("start") < F.col("e"))
    seen = both.select("h.doc_id", "h.key", "h.start", "h.rank", "h.end", "n.s", "n.e", "n.r").groupBy("doc_id", "key", "start", "rank", "end").agg(F.max(is_id & ~inside).alias("id"), F.max(is_key & ~inside).alias("secret"), F.max(inside).alias("inside"))
    linked = seen.where(~F.col("inside") & (((F.col("rank") == rank["identifier"]) & F.col("secret")) | ((F.col("rank") == rank["random"]) & F.col("id")) | ((F.col("rank") == rank["endpoint"]) & F.col("id") & F.col("secret"))))
    return linked.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "rank", "end")).alias("linked"))


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, key, base (strong parts, sorted) and spans (with linked hints, sorted) of each row."""
    found = stash(parts(documents), "secrets")
    more = links(found).select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "linked")
    joined = found.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    base = F.array_sort(F.concat(*(F.col(k[0]) for k in STRONG)))
    return joined.select("doc_id", "key", *(F.size(k[0]).cast("bigint").alias(f"n_{k[0]}") for k in STRONG), base.alias("base"), F.array_sort(F.concat(base, F.coalesce("linked", F.array().cast(_PARTS)))).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each part, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.element_at(names, p["rank"] + 1), p["start"], p["end"])), ",")


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body has it."""
    return F.transform(F.array(value), body)[0]


def masked(text: Column, spans: Column) -> Column:
    """text with MASK in place of each of the sorted spans; spans that overlap share one. The text is cut into chunks of CHUNK
    code points once, so that each part that stays costs its own length and a chunk or two."""
    place = lambda at, end: F.struct(at.alias("from"), end.alias("to"))
    gaps = "array<struct<from:bigint,to:bigint>>"

    def step(acc: Column, p: Column) -> Column:
        fresh, full, part = p["start"] >= acc["at"], F.size(acc["last"]) >= BLOCK, F.array(place(acc["at"], p["start"]))
        blocks = F.when(fresh & full, F.concat(acc["blocks"], F.array(acc["last"]))).otherwise(acc["blocks"])
        last = F.when(fresh & full, part).when(fresh, F.concat(acc["last"], part)).otherwise(acc["last"])
        return F.struct(F.greatest(acc["at"], p["end"]).alias("at"), blocks.alias("blocks"), last.alias("last"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{gaps}>").alias("blocks"), F.array().cast(gaps).alias("last"))
    # The last part ends where the text does.
    kept = F.aggregate(spans, start, step, lambda acc: F.concat(F.flatten(acc["blocks"]), acc["last"], F.array(place(acc["at"], F.lit(None).cast("bigint")))))

    def cut(chunks: Column, g: Column) -> Column:
        a, from_ = F.floor(g["from"] / CHUNK).cast("int"), (g["from"] % CHUNK).cast("int")
        b, to = F.coalesce(F.floor(g["to"] / CHUNK).cast("int"), F.size(chunks)), F.coalesce(g["to"] % CHUNK, F.lit(0)).cast("int")
        at = lambda k: F.coalesce(F.get(chunks, k), F.lit(""))
        within = F.when(b - a > 1, F.array_join(F.slice(chunks, a + 2, b - a - 1), "")).otherwise("")  # slice() copies all chunks
        return F.when(a == b, F.substring(at(a), from_ + 1, to - from_)).otherwise(F.concat(F.substring(at(a), from_ + 1, F.lit(CHUNK)), within, F.substring(at(b), F.lit(1), to)))

    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(_let(chunks, lambda c: F.array_join(F.transform(kept, lambda g: cut(c, g)), MASK)))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with MASK in place of every span; n_chars follows. Columns stay as they are.

    Strong parts are masked in the projection that finds them. Linked hints come by a join, to which texts are broadcast-joined
    while those hints are few; beyond that only texts that hold hints are shuffled.
    """
    more = stash(links(stash(parts(documents), "secrets")), "linked")
    n, hints = more.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("linked")), F.lit(0))).first()
    linked = more.select(F.struct("doc_id", "key", "linked").alias("_more"))
    # Rows travel as one struct, so that no column's name can clash.
    rows = documents.select(whole_rows(documents, "_row"))
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    of = F.col("_row.doc_id").cast("bigint").eqNullSafe(F.col("_more.doc_id")) & (F.xxhash64(text) == F.col("_more.key"))
    if max(n, hints) <= BROADCAST_GROUPS:
        both = rows.join(F.broadcast(linked), of, "left")
    else:
        hinted = F.greatest(*(text.rlike(h[1]) for h in HINTS))
        both = rows.where(hinted).join(linked, of, "left").unionByName(rows.where(~hinted).withColumn("_more", F.lit(None).cast(linked.schema["_more"].dataType)))
    found = F.concat(*(_matches(text, *k) for k in STRONG), F.coalesce(F.col("_more.linked"), F.array().cast(_PARTS)))
    out = both.select("_row", _let(F.array_sort(found), lambda spans: F.when(F.size(spans) > 0, masked(F.col("_row.text"), spans))).alias("_masked"))
    changed = {"text": F.coalesce("_masked", "_row.text")}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.coalesce(F.length("_masked").cast(documents.schema["n_chars"].dataType), F.col("_row.n_chars"))
    return out.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in documents.columns))


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
