"""Line dedup by log templates: a tree of fixed depth over token count and leading tokens."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import SPACE_CLASS, materialised

#: Leading tokens in a leaf's path.
LEADING = 3
#: Share of a line's tokens that its template must fix; tokens with a digit never count.
SIMILARITY = 0.8
#: Groups in which a line of a crowded leaf looks for its template, unless more tokens may differ.
GROUPS = 56
#: Lines of a group that one task compares others with, about.
GROUP_PART = 256
#: Tokens that a line needs to be parsed.
MIN_TOKENS = 3
#: Characters from which a line with fewer tokens counts as well, such as a passage in a script
#: without blanks.
MIN_CHARS = 32
#: Up to so many leaves or templates (48 bytes each at most) are sent to every executor; more are
#: joined by a shuffle.
BROADCAST_ROWS = 300_000
#: What stands for a token with a digit, and for a field that varies.
VARIABLE = "<*>"

_DOCUMENT = ["doc_id", "text_key"]


def _split(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(f"([^{SPACE_CLASS}]+)"), F.lit(1))


def tokens(line: Column) -> Column:
    """The line's tokens; those with a digit are variable from the start."""
    masked = F.regexp_replace(line, f"[^{SPACE_CLASS}]*[0-9][^{SPACE_CLASS}]*", VARIABLE)
    marked = F.when(line.rlike("[0-9]"), masked).otherwise(line)
    return _split(marked)


def _needed(n: Column, similarity: float) -> Column:
    """How many of a line's n tokens have to be fixed; the difference takes away rounding errors."""
    return F.ceil(n * similarity - 1e-9).cast("int")


def _lines(documents: DataFrame, min_tokens: int, similarity: float) -> DataFrame:
    """(doc_id, text_key, at, n, leaf, own, whole) of every line. n is the number of tokens;
    own a hash of the line's own template, which is its tokens with `VARIABLE` for those with a
    digit if enough of them have none (then whole is false), else the tokens as they are."""
    lines = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.posexplode(F.split("text", "\n")).alias("at", "raw"),
    )
    parsed = lines.select(*_DOCUMENT, "at", "raw", tokens(F.col("raw")).alias("tokens"))
    fixed = F.size(F.array_remove("tokens", VARIABLE))
    short = F.size("tokens") < min_tokens
    characters = F.length(F.array_join(_split(F.col("raw")), " "))
    whole = short | (F.array_contains("tokens", VARIABLE) & (fixed < _needed(F.size("tokens"), similarity)))
    own = F.when(whole, F.xxhash64(_split(F.col("raw")), F.lit(1))).otherwise(F.xxhash64("tokens"))
    return parsed.select(
        *_DOCUMENT, "at", F.size("tokens").alias("n"),
        F.when(short, 0).otherwise(
            F.xxhash64(F.size("tokens"), F.slice("tokens", 1, LEADING))
        ).alias("leaf"),
        # shorter lines count if they are long in characters
        F.when(~short | (characters >= MIN_CHARS), own).alias("own"), whole.alias("whole"),
    )


def _crowded(documents: DataFrame, keyed: DataFrame, similarity: float) -> DataFrame:
    """(id, leaf, own, first, tokens) of the distinct lines that share a leaf with others and may
    differ from them in a token or more; ids ascend with the first document.

    One place of each line is looked up in the documents, so that no line is parsed again.
    """
    parsed = keyed.where(~F.col("whole") & (F.col("n") > _needed(F.col("n"), similarity)))
    leaves = materialised(
        parsed.groupBy("leaf").agg(F.min("own").alias("low"), F.max("own").alias("high"))
        .where("low <> high").select("leaf"),
        "crowded-leaves",
    )
    places = materialised(
        parsed.join(_sent_if_small(leaves), "leaf").groupBy("leaf", "own")
        .agg(F.min(F.struct(*_DOCUMENT, "at")).alias("place")),
        "crowded-places",
    )
    wanted = places.groupBy(
        F.col("place.doc_id").alias("its_id"), F.col("place.text_key").alias("its_key")
    ).agg(F.collect_list(F.struct("place.at", "leaf", "own")).alias("lines"))
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_key") == F.col("its_key"))
    small = places.count() <= BROADCAST_ROWS
    found = texts.join(F.broadcast(wanted) if small else wanted, same).select(
        F.struct(*_DOCUMENT).alias("first"), F.split("text", "\n").alias("parts"),
        F.explode("lines").alias("line"),
    ).select("first", "line.leaf", "line.own", F.get("parts", F.col("line.at")).alias("raw"))
    # rows that are repeated have their lines as often
    once = found.groupBy("leaf", "own").agg(F.min("first").alias("first"), F.min("raw").alias("raw"))
    order = ["first", "leaf", "own"]
    return materialised(
        once.select("leaf", "own", "first", tokens(F.col("raw")).alias("tokens"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("id", F.monotonically_increasing_id()),
        "crowded-lines",
    )


def _earlier_likes(apart: DataFrame, similarity: float) -> DataFrame:
    """(leaf, own, first): for lines that share enough fixed tokens with a line of an earlier
    document, the first such document; a line may be there twice, with a later one as well.
    `apart` is as `_crowded` has it.

    Lines of one leaf have as many tokens and the same leading ones. The others are cut into
    segments, and each choice of as many segments as tokens may differ is left out once: two
    lines of one template then agree in what is left for some choice. Each such rest is a group.
    A line is compared, position by position, with the earliest line of each of its groups, and
    then with those others of them that are earlier than the earliest like found so far. Where no
    more than two tokens may differ, segments are single tokens, so that most groups have one
    template and nothing is left for the second step; in longer lines, groups are of at least one
    segment, and up to `GROUPS` of a line are as narrow as that number allows.
    """
    needed = _needed(F.size("tokens"), similarity)
    hashed = apart.select(
        "id", "leaf", F.size("tokens").alias("n"), (F.size("tokens") - needed).alias("differ"),
        F.transform("tokens", lambda token, at: F.xxhash64(at, token)).alias("marks"),
    )
    rest = F.col("n") - LEADING
    few = F.col("differ") <= max(_KEPT)
    kept = F.coalesce(*[F.when(F.col("differ") == d, q) for d, q in _KEPT.items()], F.lit(1))
    segments = F.greatest(F.least(F.col("differ") + kept, rest), F.lit(1))
    counted = hashed.withColumn("segments", segments)

    def segment(j: Column) -> Column:
        start = F.floor(j * rest / F.col("segments")).cast("int")
        end = F.floor((j + 1) * rest / F.col("segments")).cast("int")
        return _xor(F.slice("marks", start + LEADING + 1, end - start))

    cut = counted.withColumn(
        "parts", F.transform(F.sequence(F.lit(0), F.col("segments") - 1), segment)
    )
    choices = F.coalesce(*[
        F.when(
            (F.col("differ") == d) & (F.col("segments") == k),
            F.array(*(F.lit(c).cast("long") for c in _choices(min(d, k), k))),
        )
        for d, q in _KEPT.items() for k in range(1, d + q + 1)
    ])

    def left(choice: Column) -> Column:
        inside = F.transform(
            "parts", lambda part, j: F.when(_bit(choice, j) == 0, part).otherwise(0)
        )
        return F.xxhash64("leaf", choice, _xor(inside))

    # with many differences, each segment alone; the whole leaf if all segments may differ
    alone = F.when(
        F.col("segments") > F.col("differ"),
        F.transform("parts", lambda part, j: F.xxhash64("leaf", -j, part)),
    ).otherwise(F.array(F.xxhash64("leaf")))
    groups = F.when(few, F.transform(choices, left)).otherwise(alone)
    member = materialised(cut.select("id", F.explode(groups).alias("group")), "line-groups")
    founders = member.groupBy("group").agg(
        F.min("id").alias("founder"), F.count("*").alias("lines")
    ).where("lines > 1")
    joined = materialised(member.join(founders, "group").where("founder < id"), "line-founders")
    pairs = joined.select("id", F.col("founder").alias("other")).distinct()
    found = materialised(_first_likes(apart, pairs, similarity), "line-likes")
    pairs = materialised(_left_to_compare(joined.where("lines > 2"), found), "line-pairs")
    likes = found.union(_first_likes(apart, _sent_if_small(pairs), similarity))
    return likes.select("like.leaf", "like.own", F.col("like.earlier").alias("first"))


def _left_to_compare(joined: DataFrame, found: DataFrame) -> DataFrame:
    """(id, other): for each line, the lines of its groups, without their founders, that are
    earlier than itself and than its like in `found`. `joined` has the lines of groups that are no
    founders (id, group, founder, lines).

    Lines of large groups are dealt by parts of them, so that no task has all pairs of a group.
    """
    parts = F.ceil(F.col("lines") / GROUP_PART).cast("int")
    earliest = _sent_if_small(found.select("id", F.col("like.other").alias("like_id")))
    lines = (
        joined.join(earliest, "id", "left")
        .withColumn("before", F.least("id", "like_id")).where("founder < before")
        .select("id", "before", "group", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    )
    others = joined.select(
        F.col("id").alias("other"), "group", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part")
    )
    return lines.join(others, ["group", "part"]).where("other < before").select("id", "other").distinct()


def _first_likes(apart: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """(id, like): of the pairs (id, other) that share enough fixed tokens, the least other of each
    id, with the first document of that, and the leaf and own of id."""
    theirs = apart.select(
        F.col("id").alias("other"), F.col("first").alias("earlier"),
        F.col("tokens").alias("its_tokens"),
    )
    both = F.zip_with(
        "tokens", "its_tokens", lambda x, y: ((x == y) & (x != VARIABLE)).cast("int")
    )
    alike = F.aggregate(both, F.lit(0), lambda n, one: n + one) >= _needed(
        F.size("tokens"), similarity
    )
    return (
        pairs.join(apart.select("id", "leaf", "own", "tokens"), "id").join(theirs, "other")
        .where(alike)
        .groupBy("id").agg(F.min(F.struct("other", "earlier", "leaf", "own")).alias("like"))
    )


def _choices(left_out: int, segments: int) -> list[int]:
    """Bit masks of the segments that are left out."""
    return [sum(1 << j for j in c) for c in itertools.combinations(range(segments), left_out)]


def _most_kept(differ: int) -> int:
    kept = 1
    while math.comb(differ + kept + 1, differ) <= GROUPS:
        kept += 1
    return kept


#: Segments that groups keep, by how many are left out; one where more may differ. With one or two
#: left out, segments of lines of usual length are single tokens.
_KEPT = {1: 20, 2: 9} | {
    d: _most_kept(d) for d in range(3, GROUPS) if math.comb(d + 2, d) <= GROUPS
}


def _bit(mask: Column, at: Column) -> Column:
    return F.call_function("shiftright", mask, at).bitwiseAND(F.lit(1))


def _xor(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))


def _sent_if_small(frame: DataFrame) -> DataFrame:
    """With a broadcast hint if the written rows are few enough."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def drop_recurring_lines(
    documents: DataFrame, min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, text, lang, source, n_chars, n_lines, n_dropped) of every document, without the
    lines of recurring templates.

    A line's path in the tree is its number of tokens and its first three; tokens with a digit
    count as `<*>`. Lines in a leaf have one template if they share `similarity` of all their
    tokens, position by position, not counting those with a digit; a line of which too many
    tokens have a digit is a template of its own as it is, so that rows of figures are equal only
    if their figures are. A line goes from a document if it, or any line of one template with it,
    was in an earlier one (smaller doc_id, null first, then the text's hash).

    Lines with fewer than `min_tokens` tokens stay, unless they have `MIN_CHARS` characters or
    more: these recur where all of their tokens are the same, digits included.

    A document is its id and text, so repeated rows are one document and are treated alike; null
    ids count like others. A null text stays null and has no lines, an empty one has one line. A
    document can lose all its lines; its row stays, with an empty text, and n_chars is that of the
    new text. Other columns are left out, whatever their names. An empty table gives no rows.
    """
    # lines too short to count are left out after the write, so that tokens are made only once
    keyed = materialised(_lines(documents, min_tokens, similarity), "line-keys").where(
        F.col("own").isNotNull()
    )
    document = F.struct(*_DOCUMENT)
    own = keyed.groupBy("leaf", "own").agg(
        F.min(document).alias("first"), F.max(document).alias("last")
    ).where("first <> last").select("leaf", "own", "first")
    likes = _earlier_likes(_crowded(documents, keyed, similarity), similarity)
    recurring = materialised(
        own.union(likes).groupBy("leaf", "own").agg(F.min("first").alias("first")),
        "recurring-templates",
    )
    dropped = (
        keyed.join(_sent_if_small(recurring), ["leaf", "own"])
        .where(document > F.col("first"))
        .groupBy(*_DOCUMENT).agg(F.collect_set("at").alias("dropped"))
    )
    return _without(documents, dropped)


def _without(documents: DataFrame, dropped: DataFrame) -> DataFrame:
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source",
        F.xxhash64("text").alias("text_key"),
    ).alias("row")
    gone = dropped.alias("gone")
    same = F.col("row.doc_id").eqNullSafe(F.col("gone.doc_id")) & (
        F.col("row.text_key") == F.col("gone.text_key")
    )
    joined = rows.join(gone, same, "left").select("row.*", "dropped")
    split = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("dropped"))
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda at: F.get("parts", at)), "\n")
    )
    return joined.withColumn("parts", split).select(
        "doc_id", text.alias("text"), "lang", "source",
        F.length(text).cast("long").alias("n_chars"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("parts")).cast("long")
        .alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
