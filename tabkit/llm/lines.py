"""Fuzzy line dedup with DataFrame functions only: SimHash, pigeonhole blocks, edit similarity, one line per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabkit.llm.batches import broadcast_below
from tabkit.llm.graph import components
from tabkit.session import stage

BLOCK_BITS, BLOCKS = 21, 6
MOST_BITS = 26
LONG_WORD = 5
LANE_BITS, WIDE_LANE_BITS = 9, 27
AHEAD = 4


# ASCII signs other than letters, digits, space and line break; named one by one they are looked up in a table
SIGNS = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum() and c not in (0x0A, 0x20))


def normal_lines(text: str) -> Column:
    """The lines of a text in lower case, every run of ASCII signs other than letters and digits as one space, none at the ends."""
    # a lone space is what it would be replaced by, so it is no match
    plain = F.regexp_replace(F.lower(text), f"[ {SIGNS}](?:[ {SIGNS}]++|(?<! ))", " ")
    return F.split(plain, "\n")


def _ones(width: int) -> int:
    """The lowest bit of every whole lane of ``width`` bits among 63."""
    return sum(1 << at for at in range(0, 3 * BLOCK_BITS - width + 1, width))


def _sums(half: int) -> list[Column]:
    """9 counters over a line's words. Sum j holds lanes: how many words have bit j, and the bits a lane or more above it, set."""
    return [F.sum(F.shiftrightunsigned(F.col(f"h{half}"), j).bitwiseAND(F.col("ones"))).alias(f"c{half}_{j}") for j in range(LANE_BITS)]


def _majority(half: int) -> Column:
    """The SimHash bits counted in a row: set if more than half of the words have the bit.

    ``over`` has in every lane what lifts a count of more than half of the words to the lane's highest bit.
    """
    bits = [F.shiftleft(F.call_function("shiftrightunsigned", F.col(f"c{half}_{j}") + F.col("over"), F.col("high")).bitwiseAND(F.col("ones")), j) for j in range(LANE_BITS)]
    return F.call_function("shiftleft", reduce(lambda a, b: a.bitwiseOR(b), bits), F.col("part"))


def simhashes(docs: DataFrame) -> DataFrame:
    """Distinct normalised lines, told apart by 128 bits: id (64 of them), doc, line (its first place), size, s0, s1 (126 SimHash bits).

    A SimHash is made from the line's words of LONG_WORD letters or more, or of
    all its words if it has none so long. Words are counted where the line is
    read, so no text is shuffled. Counts of up to 511 words need 9 bits, and one
    row holds all counters of a line; the words of a longer line are counted in
    four rows with counters of 27 bits, for a part of the SimHash bits each.
    Equal lines have equal bits, so they, and the parts of a line, become one by
    a bitwise or.
    """
    # rows that repeat a doc_id are counted apart
    cut = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").alias("doc"), F.monotonically_increasing_id().alias("row"), F.posexplode(normal_lines("text")).alias("line", "raw"))
    cut = cut.select("doc", "row", "line", F.trim("raw").alias("norm")).where("norm <> ''")
    # what holds for the whole line is computed before its words are many rows
    one = cut.select(F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"), "doc", "row", "line", F.length("norm").alias("size"), F.col("norm").rlike(f"[^ ]{{{LONG_WORD}}}").alias("has_long"), "norm")
    most_words = F.floor((F.col("size") + 1) / F.when(F.col("has_long"), LONG_WORD + 1).otherwise(2))
    one = one.withColumn("wide", most_words >= 1 << LANE_BITS)
    # lanes of a wide row start at bits 0 and 27 of the hash, 9 and 36, 18 and 45, or 54
    parts = F.when(F.col("wide"), F.array(*[F.lit(at) for at in (0, 9, 18, 54)])).otherwise(F.array(F.lit(0)))
    of_part = ["k1", "k2", "doc", "row", "line", "size", "wide", "part"]
    one = one.select(*of_part[:-1], "has_long", "norm", F.explode(parts).alias("part"))
    words = one.select(*of_part, "has_long", F.explode(F.split("norm", " ")).alias("word"))
    # common words are short: without them, unlike lines of one language get unlike hashes
    words = words.where((F.length("word") >= LONG_WORD) | ~F.col("has_long"))
    hashes = [F.call_function("shiftrightunsigned", F.xxhash64(F.lit(half), F.col("word")), F.col("part")).alias(f"h{half}") for half in range(2)]
    ones = F.when(F.col("wide"), _ones(WIDE_LANE_BITS)).otherwise(_ones(LANE_BITS)).alias("ones")
    sums = words.select(*of_part, ones, *hashes).groupBy(*of_part).agg(F.count(F.lit(1)).alias("n_words"), *_sums(0), *_sums(1))
    high = F.when(F.col("wide"), WIDE_LANE_BITS - 1).otherwise(LANE_BITS - 1)
    over = (F.when(F.col("wide"), (1 << WIDE_LANE_BITS - 1) - 1).otherwise((1 << LANE_BITS - 1) - 1) - F.expr("n_words div 2")) * ones
    bits = sums.withColumns({"ones": ones, "high": high, "over": over})
    bits = bits.select("k1", "k2", F.struct("doc", "line").alias("at"), "size", _majority(0).alias("s0"), _majority(1).alias("s1"))
    one = bits.groupBy("k1", "k2").agg(F.min("at").alias("at"), F.min("size").alias("size"), F.bit_or("s0").alias("s0"), F.bit_or("s1").alias("s1"))
    return stage(one.select(F.col("k1").alias("id"), F.col("at.doc").alias("doc"), F.col("at.line").alias("line"), "size", "s0", "s1"))


def _buckets(lines: DataFrame) -> DataFrame:
    """(id, s0, s1, size, key) of every block of every line; the key holds block number, block value and length class.

    Classes are powers of four; a line that a line up to a quarter longer would
    find in the next class goes there too, so no pair of similar length parts.
    """
    values = [F.shiftright(F.col(f"s{b // 3}"), (b % 3) * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for b in range(BLOCKS)]
    kind = ((F.length(F.bin("size")) - 1) / 2).cast("int")
    reach = ((F.length(F.bin(F.ceil(F.col("size") * 1.25))) - 1) / 2).cast("int")
    placed = lines.select("id", "s0", "s1", "size", *[v.alias(f"b{i}") for i, v in enumerate(values)], F.explode(F.array_distinct(F.array(kind, reach))).alias("kind"))
    keys = F.array(*[F.col(f"b{i}") + F.lit(i << 24) + F.shiftleft(F.col("kind").cast("long"), 40) for i in range(BLOCKS)])
    # in this order both sides of a join of the rows with themselves are one shuffle
    return placed.select("id", "s0", "s1", "size", F.explode(keys).alias("key"))


def _near(a: str, b: str, least: float) -> Column:
    """Lines a and b are of similar length and differ in at most MOST_BITS bits."""
    bits = F.bit_count(F.col(f"{a}s0").bitwiseXOR(F.col(f"{b}s0"))) + F.bit_count(F.col(f"{a}s1").bitwiseXOR(F.col(f"{b}s1")))
    return (F.least(f"{a}size", f"{b}size") >= least * F.greatest(f"{a}size", f"{b}size")) & (bits <= MOST_BITS)


def similar_lines(lines: DataFrame, docs: DataFrame, least: float) -> DataFrame | None:
    """(node, component) of lines that are linked: they share a block, differ in at most MOST_BITS bits and have edit similarity >= least.

    A bucket's key has 21 bits, so lines without any likeness share more and
    more buckets as lines grow. One shuffle by bucket therefore keeps only the
    rows that have a partner in their bucket by length and bits; a row leaves
    the search at its first one, and the others cost a comparison each and
    give no row. Of the rest a line meets the line before it in hash order and
    the bucket's first. Then rounds go over the rows that still have a partner
    of another component in their bucket: all of them meet a few centres, which
    leave the bucket, as they have met everything in it; the others stay,
    linked or not. The number of centres grows eightfold a round until no row
    has such a partner, so no pair of two components is left out.
    """
    rows = _buckets(lines)
    mine, others = rows.alias("x"), rows.alias("y")
    shared = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") != F.col("y.id")) & _near("x.", "y.", least)
    rows = stage(mine.join(others.hint("merge"), shared, "left_semi"))
    if rows.isEmpty():
        return None
    w = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(8), "id"), "id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    me = F.struct("id", "s0", "s1", "size")
    mates = [F.lag(me, 1).over(w), F.nth_value(me, 1).over(before)]
    met = rows.select("*", *[m.alias(f"m{i}") for i, m in enumerate(mates)])
    met = met.select("id", F.explode(F.array_compact(F.array(*[F.when(_near("", f"m{i}.", least), F.col(f"m{i}.id")) for i in range(len(mates))]))).alias("mate"))
    pairs = stage(met.where("id <> mate").select(F.least("id", "mate").alias("a"), F.greatest("id", "mate").alias("b")).distinct())
    links = stage(_verified(pairs, lines, docs, least))
    labels = None if links.isEmpty() else components(links)
    # links found later join the first components, a graph far smaller than all links
    rows = rows.withColumn("base", F.col("id"))
    if labels is not None:
        rows = rows.join(broadcast_below(labels.toDF("id", "component")), "id", "left").withColumn("base", F.coalesce("component", "id")).drop("component")
    rows = stage(rows)
    joins, moved = None, None
    few = 8
    while True:
        now = rows.withColumn("comp", F.col("base"))
        if moved is not None:
            now = rows.join(broadcast_below(moved.toDF("base", "component")), "base", "left").withColumn("comp", F.coalesce("component", "base")).drop("component")
        # buckets that still hold two components, and in them the rows with a partner of another one
        torn = now.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
        now = stage(now.join(broadcast_below(stage(torn)), "key", "left_semi"))
        mine, others = now.alias("x"), now.alias("y")
        apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & _near("x.", "y.", least)
        now = stage(mine.join(others.hint("merge"), apart, "left_semi"))
        if now.isEmpty():
            break
        top = now.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64(F.lit(few), "id"), "id"))).where(F.col("r") <= few).drop("r")
        top = stage(top.select("key", *[F.col(c).alias(f"c_{c}") for c in ("id", "s0", "s1", "size", "base", "comp")]))
        star = now.join(broadcast_below(top), "key").where((F.col("comp") != F.col("c_comp")) & _near("", "c_", least))
        ends = F.struct("id", "base"), F.struct(F.col("c_id").alias("id"), F.col("c_base").alias("base"))
        star = star.select(F.least(*ends).alias("p"), F.greatest(*ends).alias("q")).select(F.col("p.id").alias("a"), F.col("q.id").alias("b"), F.col("p.base").alias("p"), F.col("q.base").alias("q"))
        star = stage(star.distinct().join(pairs, ["a", "b"], "left_anti"))
        if not star.isEmpty():
            pairs = pairs.unionByName(star.select("a", "b"))
            new = stage(_verified(star.select("a", "b"), lines, docs, least).join(star, ["a", "b"]).select("p", "q"))
            if not new.isEmpty():
                joins = new if joins is None else joins.unionByName(new)
                moved = components(joins, "p", "q")
        met = broadcast_below(top.select("key", F.col("c_id").alias("id")))
        rows = stage(now.join(met, ["key", "id"], "left_anti").select(rows.columns))
        few *= 8
    if labels is None or moved is None:
        return moved if labels is None else labels
    later = labels.join(broadcast_below(moved.toDF("component", "to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return stage(later.unionByName(moved.join(labels.select("node"), "node", "left_anti")))


def _verified(pairs: DataFrame, lines: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """(a, b) of the pairs with edit similarity 1 - distance / longer length >= least, on the whole normalised lines.

    The lines of the pairs are read again from their first place; only texts
    of documents that hold one take part.
    """
    ids = stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    spots = lines.select("id", "doc", "line").join(broadcast_below(ids), "id")
    held = spots.groupBy("doc").agg(F.collect_list(F.struct("line", "id")).alias("spots"))  # at most a document's own lines
    text = docs.select(F.col("doc_id").alias("doc"), "text").join(broadcast_below(stage(held)), "doc")
    text = text.withColumn("raw", F.split("text", "\n")).select("raw", F.explode("spots").alias("s"))
    text = text.select(F.col("s.id").alias("id"), F.get(F.col("raw"), F.col("s.line")).alias("raw"))
    text = text.select("id", F.trim(F.element_at(normal_lines("raw"), 1)).alias("norm"))
    text = text.groupBy("id").agg(F.first("norm").alias("norm"))
    both = pairs.join(text.toDF("a", "a_norm"), "a").join(text.toDF("b", "b_norm"), "b")
    return both.where(_within("a_norm", "b_norm", least)).select("a", "b")


def _by_words(x: Column, y: Column, most: Column) -> Column:
    """Whether one way of turning words x into words y takes at most ``most`` edits; the edit distance of the lines is no more.

    Word by word: equal words are kept; if the word stands a little later in y,
    the words before it are put in; if y's word stands a little later in x, this
    one is left out; else one word is changed into the other.
    """
    whole = lambda words: F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w) + 1)

    def step(s: Column, i: Column) -> Column:
        word, there = F.get(x, i), F.get(y, s["j"])
        state = lambda j, cost: F.struct(j.alias("j"), cost.alias("cost"))
        later = F.array_position(F.slice(y, s["j"] + 2, F.lit(AHEAD)), word).cast("int")
        gone = F.array_position(F.slice(x, i + 2, F.lit(AHEAD)), there) > 0
        put_in = state(s["j"] + later + 1, s["cost"] + whole(F.slice(y, s["j"] + 1, later)))
        left_out = state(s["j"], s["cost"] + F.length(word) + 1)
        changed = state(s["j"] + 1, s["cost"] + F.levenshtein(word, there))
        return F.when(word == there, state(s["j"] + 1, s["cost"])).when(s["cost"] > most, s).when(later > 0, put_in).when(there.isNull() | gone, left_out).otherwise(changed)

    start = F.struct(F.lit(0).alias("j"), F.lit(0).alias("cost"))
    return F.aggregate(F.sequence(F.lit(0), F.size(x) - 1), start, step, lambda s: s["cost"] + whole(F.slice(y, s["j"] + 1, F.size(y))) <= most)


def _within(a: str, b: str, least: float) -> Column:
    """Whether the edit distance of lines a and b is at most 1 - least of the longer one's length.

    If one way word by word takes little enough the answer is yes, in a time that
    grows with the line and not with its square. Else equal words at both ends,
    which change nothing, are cut off and the distance of the rest is taken.
    """
    most = F.floor((1 - least) * F.greatest(F.length(a), F.length(b)) + 1e-9).cast("int")
    # as fields of a lambda's variable the words are split once, not wherever they are named
    pair = F.struct(F.split(a, " ").alias("x"), F.split(b, " ").alias("y"), most.alias("most"))
    return F.exists(F.array(pair), lambda t: _by_words(t["x"], t["y"], t["most"]) | _between_ends(t["x"], t["y"], t["most"]))


def _between_ends(x: Column, y: Column, most: Column) -> Column:
    """Whether the edit distance of the lines with words x and y, without equal words at their ends, is at most ``most``."""
    # the longer line's surplus counts as a difference; equal lines have none
    same = lambda u, v: F.array_position(F.zip_with(u, v, lambda p, q: p.eqNullSafe(q)), False) - 1
    head = F.greatest(same(x, y), F.lit(0)).cast("int")
    tail = F.least(F.greatest(same(F.reverse(x), F.reverse(y)), F.lit(0)), F.least(F.size(x), F.size(y)) - head).cast("int")

    def distance(ends: Column) -> Column:
        middle = lambda c: F.array_join(F.transform(F.slice(c, ends["head"] + 1, F.size(c) - ends["head"] - ends["tail"]), lambda w: F.concat(w, F.lit(" "))), "")
        return F.call_function("levenshtein", middle(x), middle(y), most) >= 0

    return F.exists(F.array(F.struct(head.alias("head"), tail.alias("tail"))), distance)


BLANK = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def cut_documents(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, keep): the numbers of the lines with words that stay, of every document that loses one."""
    lines = simhashes(docs)
    labels = similar_lines(lines, docs, least)
    if labels is None:
        keep = lines.select("doc", "line")
    else:
        known = lines.select("id", F.struct("doc", "line").alias("at")).join(broadcast_below(labels.withColumnRenamed("node", "id")), "id", "left")
        alone = known.where("component is null").select("at")
        first = known.where("component is not null").groupBy("component").agg(F.min("at").alias("at")).select("at")
        keep = alone.unionByName(first).select("at.doc", "at.line")
    keep = keep.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_set("line").alias("keep"))
    full = F.size(F.filter(F.split("text", "\n"), lambda s: s.rlike(BLANK)))
    had = docs.where("doc_id is not null and text is not null").groupBy("doc_id").agg(F.max(full).alias("had")).where("had > 0")
    out = had.join(keep, "doc_id", "left").withColumn("keep", F.coalesce("keep", F.array().cast("array<int>")))
    return stage(out.where(F.size("keep") < F.col("had")).select("doc_id", "keep"))


def dedup_lines(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """docs with fuzzy repeats of lines cut from text; also n_lines and n_removed.

    Lines are compared after lower-casing, with ASCII signs other than letters
    and digits as one space. Equal lines, and lines linked by edit similarity
    >= least among those that share one of six SimHash blocks, form groups;
    of a group the place with the smallest (doc_id, line) stays. Lines of
    such signs alone always stay. Any pair within five SimHash bits shares a
    block; farther pairs mostly do.

    Null text stays null with 0 lines; a text that loses all its lines becomes
    empty and its row stays. Rows with null doc_id stay whole. Rows that repeat
    a doc_id keep the same line numbers, those kept for any of them. Only
    documents that lose a line are rebuilt; no text is shuffled for it while
    their line numbers are small enough to broadcast (their size is checked). A line of
    over 2**27 words may get a blurred SimHash, no more. Other columns pass
    through; n_lines and n_removed replace columns of that name.
    """
    base = docs.withColumn("text", F.col("text").cast("string"))
    cut = cut_documents(base.select("doc_id", "text"), least)
    out = base.join(broadcast_below(cut.withColumnRenamed("keep", "_keep")), "doc_id", "left")
    out = out.withColumn("_lines", F.split("text", "\n"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    blank = F.filter(every, lambda i: ~F.get(F.col("_lines"), i).rlike(BLANK))
    stay = F.array_sort(F.array_union(F.filter("_keep", lambda i: i < F.size("_lines")), blank))
    stay = F.when(F.col("_keep").isNull(), every).otherwise(stay)
    out = out.withColumn("_stay", F.when(F.col("text").isNotNull(), stay))
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("_lines")).cast("long")
    out = out.withColumn("n_lines", n).withColumn("n_removed", n - F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("_stay")))
    text = F.array_join(F.transform("_stay", lambda i: F.get(F.col("_lines"), i)), "\n")
    return out.withColumn("text", F.when(F.col("_keep").isNull(), F.col("text")).when(F.col("text").isNotNull(), text)).select(*[c for c in docs.columns if c not in ("n_lines", "n_removed")], "n_lines", "n_removed")
