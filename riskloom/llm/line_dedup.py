"""Line dedup by a segment-partition edit join, with DataFrame and SQL functions only.

Two lines link when their edit distance (in characters) is at most ``edits``, and with ``edit_chars`` also at
most one edit for each ``edit_chars`` characters of the shorter line; linked lines, over any
number of links, are one cluster, and its first line by (document id, line number) is kept.

Method (segment partition after PassJoin: Li et al. 2011).  Of ``edits + 1`` segments of a line one stays whole under
``edits`` edits, and there is one with as many edits to its left as segments, and no more to its right than segments
there.  Lines of nearly one length form a bucket; its least length gives the segments' size.  Segments of the first half are
counted from the line's start, the others from its end, so a length needs no keys of its own: a segment is met by the substrings
shifted by at most the edits on that side, eight keys a line at three edits.  Lines are indexed by (bucket, segment
number, segment); each line probes its own bucket, and the next lower one where a line of that can be within the edits.  A line's own segments
serve as its probes without a shift.  Index keys and probes are rows of two numbers, dealt by key once; texts stay where
they are.  Only keys that hold an indexed line and a second line go on (*postings*).

Candidates meet heads first: every line of a key is compared with the key's smallest indexed line, which is linear in the
postings.  Keys whose lines are still in several components get a second head from the lines outside the first
one's component, and only keys that hold several components after ``HEADS`` rounds are compared pair by pair, between
components.  A line in a posting has a signature, its length and the parities of its counts of ``LETTERS``; an edit changes two of them
at most, so pairs that differ in more than ``2 * edits`` parities or ``edits`` characters are dropped before their texts meet.
The rest is verified by ``levenshtein`` with a threshold.

The texts of lines in postings alone are fetched for that, once, by a bitmap of line hashes of fixed size (a superset; the
join after it is exact).  Lines are named by a 63-bit hash.  Components run by graph rounds.

Defined results: lines shorter than ``min_chars`` and blank ones take no part and have no row; lines too short for
an edit (``edits`` characters, or under ``edit_chars``) link by equality alone, at any length; null text has
no lines; rows of one id count as one document, whose equal line numbers are one place; a null id sorts before
all others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.graph import components
from riskloom.llm.state import BITMAP_LOG2, cut, few, unused


LETTERS = "etaoinsrhldcumfpgwybvkxjqz .,013"
HEADS = 3  #: rounds in which a key's lines meet one line only


def line_id(line: str = "line") -> Column:
    """Hash of a line; the lowest bit is free to mark postings of the index."""
    return F.xxhash64(line).bitwiseAND(F.lit(-2))


def _levels(edits: int, edit_chars: int | None) -> list[tuple[int, int, int | None]]:
    """(allowed edits, least length, length from which more are allowed) of the lines in the edit join."""
    if not edit_chars:
        return [(edits, edits + 1, None)]
    return [(k, k * edit_chars, (k + 1) * edit_chars if k < edits else None) for k in range(1, edits + 1)]


def _buckets(levels: list) -> str:
    """SQL array of (parts, lower, low, end): the buckets of a level that a line may reach, its own or highest and the one below."""
    return ", ".join(f"named_struct('parts', {edits + 1}, 'lower', {down}, 'low', {low}, 'end', {end or 2 ** 31 - 1})"
                     for edits, low, end in levels for down in (0, 1))


def _keys(edits: int) -> str:
    """SQL array of (segment, shift, right): the substrings of a line that may be a segment; ``right``: counted from its end."""
    out = []
    for i in range(edits + 1):
        most = min(i, edits - i)
        out += [f"named_struct('i', {i}, 'd', {d}, 'right', {str(i > edits - i).lower()})" for d in range(-most, most + 1)]
    return f"array({', '.join(out)})"


def _into(x: str) -> str:
    """SQL: characters from the start of the bucket of a length that is ``x`` above its level's least.

    Buckets are wider than the edits, so a line reaches two at most.
    """
    return f"({x}) % if({x} < 12 * parts, parts, 4 * parts)"


def _posted(lines: DataFrame, levels: list) -> DataFrame:
    """(key, tag) of all keys of all lines; the tag is the line's id, plus one if the key is its own segment."""
    edits, low, _ = levels[-1]
    each = lines.where(F.col("chars") >= levels[0][1]).select(line_id().alias("id"), "line", "chars", F.expr(
        "octet_length(line) = chars").alias("plain"))
    # a long line's partners are all of the last level; expressions of a line stand before its rows are made
    line = ("id", "line", "chars", "plain")
    each = each.selectExpr(*line, f"inline(if(chars >= {low + edits}, array({_buckets(levels[-1:])}), array({_buckets(levels)})))")
    each = each.selectExpr(*line, "parts", "low", "lower = 0 and chars < end as own", "lower", "least(chars, end - 1) as m")
    each = each.selectExpr(*line, "parts", "low", "own", f"if(lower = 0, m, m - 1 - {_into('m - low')}) as m")
    each = each.where("m >= low and chars - m < parts").selectExpr(*line, "parts", "own", f"m - {_into('m - low')} as base")
    by_parts = " ".join(f"when {k + 1} then {_keys(k)}" for k, _, _ in levels)
    each = each.selectExpr(*line, "parts", "own", "base", "cast(base div parts as int) as size")
    each = each.selectExpr(*line, "parts", "own", "base", "size", f"inline(case parts {by_parts} end)")
    each = each.selectExpr(*line, "i", "own and d = 0 as own", "base", "size", "if(right, chars - size * (parts - i), size * i) + d as at")
    # characters are bytes in a plain line, so its pieces need no search for their start
    piece = "if(plain, substring(cast(line as binary), at + 1, size), cast(substring(line, at + 1, size) as binary))"
    return each.where("at >= 0 and at + size <= chars").selectExpr(f"xxhash64(base, i, {piece}) as key", "id + int(own) as tag")


def _signature(line: str) -> Column:
    """Bit i: whether the line holds an odd number of letter i; the length stands above them."""
    odd = " | ".join(f"shiftleft(cast((length({line}) - length(replace({line}, '{c}', ''))) & 1 as bigint), {i})"
                     for i, c in enumerate(LETTERS))
    return F.expr(f"{odd} | shiftleft(cast(length({line}) as bigint), {len(LETTERS)})")


def _postings(lines: DataFrame, levels: list) -> DataFrame:
    """(key, id, own, sign) of keys that hold an indexed line and another line."""
    return _postings_and_texts(lines, levels)[0]


def _postings_and_texts(lines: DataFrame, levels: list) -> tuple[DataFrame, DataFrame]:
    """``_postings``, and (id, line) of the lines in them."""
    whole = Window.partitionBy("key")
    own = F.col("tag").bitwiseAND(F.lit(1)) == 1
    id_ = F.col("tag").bitwiseAND(F.lit(-2))
    met = (_posted(lines, levels).withColumn("any", F.max(F.col("tag").bitwiseAND(F.lit(1))).over(whole))
           .withColumn("low", F.min("tag").over(whole)).withColumn("high", F.max("tag").over(whole)))
    met = cut(met.where("any = 1 and low & -2 <> high & -2").select("key", id_.alias("id"), own.alias("own")).distinct())
    rows = met.count()
    met = few(met, rows)
    wanted = met.select("id").distinct()
    texts = cut(few(_texts(lines, wanted).join(wanted, "id", "left_semi"), rows, 20_000))
    return cut(few(met.join(texts.select("id", _signature("line").alias("sign")), "id").select("key", "id", "own", "sign"), rows)), texts


def banded_distance(a: str, b: str, edits: int) -> Column:
    """Edit distance of the string columns ``a`` and ``b`` if it is at most ``edits``, else a larger number."""
    d = F.levenshtein(a, b, edits)
    return F.when(d < 0, edits + 1).otherwise(d)


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    return (docs.select(F.col(id_col).alias("doc"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("line_no", "line"))
            .withColumn("chars", F.length("line")).where((F.col("chars") >= min_chars) & F.col("line").rlike(r"\S")))


def _named(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, line) of the lines named in ``wanted``, and of a few that share their bit; nothing is shuffled."""
    mask = F.lit((1 << BITMAP_LOG2) - 1)
    bit = lambda c: F.shiftright(c, 1).bitwiseAND(mask)
    words = (wanted.groupBy(F.shiftright(bit("id"), 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftright(id, 1) & 63 as int))")).alias("bits")))  # at most 2**18 rows
    named = lines.withColumn("id", line_id()).withColumn("word", F.shiftright(bit("id"), 6))
    return named.join(F.broadcast(words), "word").where(F.expr("shiftright(bits, cast(shiftright(id, 1) & 63 as int)) & 1 = 1")).select("id", "line")


def _texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """One (id, line) for each line that ``_named`` finds."""
    return _named(lines, wanted).groupBy("id").agg(F.min("line").alias("line"))


def _linked(a: str, b: str, edits: int, edit_chars: int | None) -> Column:
    """Whether two lines are within the allowed edits."""
    most = F.lit(edits)
    if edit_chars:
        most = F.least(most, F.floor(F.least(F.length(a), F.length(b)) / edit_chars).cast("int"))
    return banded_distance(a, b, edits) <= most


def _verified(texts: DataFrame, pairs: DataFrame, edits: int, edit_chars: int | None) -> DataFrame:
    """(u, v) of the pairs (a, b) within the allowed edits."""
    both = (pairs.distinct().join(texts.select(F.col("id").alias("a"), F.col("line").alias("la")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("line").alias("lb")), "b"))
    return cut(both.where(_linked("la", "lb", edits, edit_chars)).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _near(a: str, b: str, edits: int) -> Column:
    """Whether two signatures allow ``edits`` edits."""
    n = len(LETTERS)
    odd = F.bit_count(F.col(a).bitwiseXOR(F.col(b)).bitwiseAND(F.lit((1 << n) - 1)))
    return (odd <= 2 * edits) & (F.abs(F.shiftright(a, n) - F.shiftright(b, n)) <= edits)


def _open(postings: DataFrame, links: DataFrame) -> DataFrame:
    """Postings with their components, of the keys whose lines are in several components, one of them indexed."""
    roots = components(links)
    named = (postings.join(roots.withColumnRenamed("node", "id"), "id", "left")
             .select("key", "id", "own", "sign", F.coalesce("root", "id").alias("root")))
    many = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return named.join(many, "key")


def _met(postings: DataFrame, heads: DataFrame, edits: int) -> DataFrame:
    """(a, b) of each line and its key's head."""
    both = postings.join(heads.select("key", F.col("head.id").alias("head"), F.col("head.sign").alias("head_sign")), "key")
    return both.where((F.col("id") != F.col("head")) & _near("sign", "head_sign", edits)).select(*_pair("id", "head"))


def line_links(lines: DataFrame, edits: int, edit_chars: int | None = None) -> DataFrame:
    """(u, v) of lines within ``edits`` edits, or as many as the shorter line's length allows.

    Not every such pair, but links that join the same lines to components as all of them would.
    """
    left, texts = _postings_and_texts(lines, _levels(edits, edit_chars))
    rows = left.count()
    least = F.min(F.struct("id", "sign")).alias("head")
    heads, links = cut(few(left.where("own").groupBy("key").agg(least), rows)), None
    for _ in range(HEADS):
        found = _verified(texts, _met(left, heads, edits), edits, edit_chars)
        links = few(found if links is None else cut(links.union(found)), rows)
        left = cut(few(_open(left.select("key", "id", "own", "sign"), links), rows))
        if left.isEmpty():
            return links
        # the next heads: the smallest indexed lines outside the components of the last ones
        last = heads.select("key", F.col("head.id").alias("head"))
        of = left.join(last, "key").where("id = head").select("key", F.col("root").alias("head_root")).distinct()
        heads = cut(few(left.join(of, "key").where("own and root <> head_root").groupBy("key").agg(least), rows))
    # the texts of a key's lines meet once a key, those that are linked alone leave the join
    left = left.join(texts, "id")
    a, b = left.where("own").alias("a"), left.alias("b")
    rest = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.root") != F.col("b.root")) & (~F.col("b.own") | (F.col("a.id") < F.col("b.id")))
                  & _near("a.sign", "b.sign", edits) & _linked("a.line", "b.line", edits, edit_chars))
    return links.union(cut(rest.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()))


def line_clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 3,
                  min_chars: int = 1, edit_chars: int | None = 4) -> DataFrame:
    """(id, line_no, cluster_doc, cluster_line, n_equal, kept) of every line of at least ``min_chars`` characters.

    ``cluster_doc`` and ``cluster_line`` name the cluster's first line, ``n_equal`` counts equal lines.
    """
    if not 1 <= edits <= 20 or min_chars < 1 or edit_chars is not None and edit_chars < 2:
        raise ValueError("line_clusters: 1 to 20 edits, lines of a character at least, and two characters or more an edit")
    lines = _lines(docs, id_col, text_col, min_chars)
    marks = cut(lines.select("doc", "line_no", line_id().alias("id")))
    joined = components(line_links(lines, edits, edit_chars))
    place = F.struct("doc", "line_no")
    classes = (marks.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("n_equal"))
               .join(joined, F.col("id") == F.col("node"), "left").where("n_equal > 1 or root is not null")
               .withColumn("root", F.coalesce("root", "id")).select("id", "root", "first", "n_equal"))
    heads = classes.groupBy("root").agg(F.min("first").alias("head"))
    classes = classes.join(heads, "root").select("id", "head", "n_equal")
    return (marks.join(classes, "id", "left").withColumn("head", F.coalesce("head", place))
            .select(F.col("doc").alias(id_col), "line_no", F.col("head.doc").alias("cluster_doc"),
                    F.col("head.line_no").alias("cluster_line"), F.coalesce("n_equal", F.lit(1)).alias("n_equal"),
                    F.col("head").eqNullSafe(place).alias("kept")))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = 3,
                           min_chars: int = 1, edit_chars: int | None = 4) -> DataFrame:
    """``docs`` with only the first line of every cluster in the texts; lines that take no part stay.

    Repeated rows of one id lose the same line numbers.
    """
    own, lines = unused(docs, "_id"), unused(docs, "_gone")
    gone = (line_clusters(docs, id_col, text_col, edits, min_chars, edit_chars).where("not kept")
            .groupBy(F.col(id_col).alias(own)).agg(F.collect_set("line_no").alias(lines)))  # lines of one document
    text = F.split(F.col(text_col).cast("string"), "\n")
    # by hash, so a document of many lines takes time in proportion to them
    numbers = F.array_except(F.sequence(F.lit(0), F.size(text) - 1), lines)
    kept = F.transform(numbers, lambda i: F.get(text, i))
    return (docs.join(gone, F.col(id_col).eqNullSafe(F.col(own)), "left")
            .withColumn(text_col, F.when(F.col(lines).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")))
            .drop(own, lines))
