"""Fuzzy line dedup, DataFrame functions only.

Lines are normalised (lower case, digits as 0, punctuation and extra blanks dropped). Candidates meet on pigeonhole
blocks: the line's ``chosen`` distinct words that come first by their hash, those of ``LONG`` bytes or more before shorter
and so more frequent ones, cut the line; a block is two neighbouring chosen words and the number of words from one to
the other. An edit spoils the block that it falls in and leaves the others, wherever they stand, so near lines share
some. (Blocks of the SimHash bits themselves cannot do this: see the README for figures.) Candidates get a 64-bit
SimHash of their words; a pair is near if the SimHashes differ in at most ``budget`` bits and the words have an edit
similarity (1 - edit distance / words of the longer line) of ``similarity`` or more. Random lines differ in 32 bits,
lines of similarity 0.8 in about 11, so with a budget of 24 the edit similarity decides. Connected near lines are one
group; of each group the first line by (doc_id, line number) stays and the rest go.

A block's lines are compared with its least line. Lines linked by that, over all blocks, are put into groups. In each block the lines outside its most frequent group (the rest) are compared with those of all other groups, so that near
lines of a block always end in one group, and blocks of one group alone are done. In blocks of more than ``CROWD`` lines, only
lines that share one of their rarest words meet: lines of similarity s agree in s of the longer one's words, so among the
1 - s of the words (and one more) that come first in any one order they have some in common. What leaves this join has
passed a bound on the edit distance: each word switches one of 64 * ``LANES`` bits, a replaced word two of them, so lines at
d edits differ in 2 d bits at most, less the difference of their lengths. No pair is lost by either; a block whose rest has
the same few words throughout stays quadratic in comparisons, though not in rows. The README states the recall against all pairs.

Defined cases: null text has no lines and comes back as it came; blank lines, and lines without a letter or digit, are never removed; equal rows
(same id and text) count once and their lines as the same place, so all keep or lose them alike; different texts of one id, or without an id, are documents
of their own, ordered by the hash of their text; equal lines inside one document are duplicates like any other. Texts and lines of any length are read
whole. Lines of fewer than five words are near their equals only. Other columns are untouched. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.components import connected_components
from panelforge.llm.scratch import discard, materialize

#: The ASCII punctuation that normalisation turns into blanks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\t\r\x0b\x0c"
#: Words whose bits are counted in lanes of 8 bits, and words of a line whose majorities are read from the lanes.
RUN, SHORT = 120, 64
ONES = 0x0101010101010101
#: Bytes of a word that counts as long.
LONG = 6
#: Lines of a block from which on only those that share a rare word are compared, and groups of words whose lines are counted.
CROWD, COUNTED = 32, 1 << 16
#: Longs that hold the bits switched by a line's words.
LANES = 4
SIGNS = ["sim", "total", *(f"odd{k}" for k in range(LANES))]


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def word_code(word: Column) -> Column:
    """A positive long that names a word and sorts those of ``LONG`` bytes or more first."""
    name = F.shiftrightunsigned(F.xxhash64(word), 4)
    return F.when(F.octet_length(word) >= LONG, name).otherwise(name.bitwiseOR(_long(1 << 61)))


def words_of(line: Column) -> Column:
    """Codes of the line's normalised words in order."""
    plain = F.translate(F.lower(line), "123456789" + PUNCTUATION, "0" * 9 + " " * len(PUNCTUATION))
    return F.array_remove(F.transform(F.split(plain, " "), word_code), word_code(F.lit("")))


def once(*columns: Column) -> Column:
    """A generator over one struct, so that what stands above it reads the values instead of computing them again."""
    return F.inline(F.array(F.struct(*columns)))


def simhash(words: Column) -> Column:
    """Bits set in more than half of ``words``, an array of hashes."""
    half = F.shiftright(F.size(words), 1).cast("long")

    def counted(hashes: Column) -> Column:
        lane = lambda k: F.aggregate(hashes, _long(0), lambda c, h: c + F.shiftrightunsigned(h, k).bitwiseAND(_long(ONES)))
        return F.array(*[lane(k) for k in range(8)])

    # lane c is over half if c + 63 - half reaches 64; at most 64 words leave the lanes' last bits free
    room = (_long(SHORT - 1) - half) * _long(ONES)
    top = [F.shiftrightunsigned, F.shiftleft]
    lanes = lambda c: [top[k > 6]((F.get(c, k) + room).bitwiseAND(_long(ONES << 6)), abs(6 - k)) for k in range(8)]

    def joined(parts: list[Column]) -> Column:
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseOR(p)
        return out

    # wrapped in one-element arrays, so that the counts are computed once
    short = F.get(F.transform(F.array(counted(words)), lambda c: joined(lanes(c))), 0)
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / RUN).cast("int")), lambda i: counted(F.slice(words, i * RUN + 1, RUN)))

    def bit(all_runs: Column, b: Column) -> Column:
        total = F.aggregate(all_runs, _long(0), lambda t, c: t + F.call_function("shiftrightunsigned", F.get(c, b % 8), b - b % 8).bitwiseAND(_long(255)))
        return F.when(total > half, F.call_function("shiftleft", _long(1), b)).otherwise(_long(0))

    wide = F.get(F.transform(F.array(runs), lambda r: F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: bit(r, b)), _long(0), lambda x, y: x.bitwiseOR(y))), 0)
    return F.when(F.size(words) <= SHORT, short).otherwise(wide)


def block_keys(words: Column, top: Column, chosen: int) -> list[Column]:
    """A hash for each block between the chosen words ``top``; slots that lines of few words leave free hash single words."""
    # place in the line and in ``top`` of each chosen word, in line order
    placed = F.transform(top, lambda w, i: F.shiftleft(F.array_position(words, w).cast("long"), 8).bitwiseOR(i.cast("long")))
    spots = F.col("spots")
    place = lambda i: F.shiftright(F.get(spots, i), 8)
    word = lambda i: F.get(top, F.get(spots, i).bitwiseAND(_long(255)).cast("int"))
    block = lambda i: F.xxhash64(word(i), word(i + 1), place(i + 1) - place(i))
    single = lambda i: F.when(F.size(top) > i, F.xxhash64(F.get(top, i)))
    blocks = [F.when(F.size(top) > i + 1, block(i)).otherwise(single(chosen - 2 - i)) for i in range(chosen - 1)]
    return [F.sort_array(placed).alias("spots"), *[k.alias(f"k{i}") for i, k in enumerate(blocks)]]


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with _copy: 0 where the id is that of one row, else the text's hash, which tells the id's texts apart."""
    repeated = docs.groupBy(F.col(id_col).alias("_again")).count().where("count > 1").select("_again", F.lit(True).alias("_is"))
    repeated = materialize(repeated)
    if repeated.isEmpty():
        return docs.withColumn("_copy", _long(0))
    copy = F.when(F.col("_is"), F.xxhash64(text_col).bitwiseOR(_long(1))).otherwise(_long(0))
    return docs.join(repeated, docs[id_col].eqNullSafe(repeated["_again"]), "left").select(*docs.columns, copy.alias("_copy"))


def line_marks(docs: DataFrame, chosen: int, id_col: str, text_col: str) -> DataFrame:
    """doc, copy, line, h (64 bits that name the normalised line), k0, k1, ... (its blocks) of each line that has a word."""
    docs = docs.select(F.col(id_col).alias("doc"), F.col("_copy").alias("copy"), F.col(text_col).alias("text"))
    # equal rows count once
    docs = docs.where("copy = 0").unionByName(docs.where("copy <> 0").dropDuplicates(["doc", "copy"]))
    lines = docs.select("doc", "copy", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    coded = lines.select("doc", "copy", "line", once(words_of(F.col("raw")).alias("words"))).where(F.size("words") > 0)
    # repeated words beyond three for each chosen one are not looked past
    top = F.when(F.size("words") > 4, F.slice(F.array_distinct(F.slice(F.sort_array("words"), 1, 3 * chosen)), 1, chosen))
    coded = coded.select("doc", "copy", "line", once(F.xxhash64("words").alias("h"), F.col("words"), top.alias("top")))
    spots, *keys = block_keys(F.col("words"), F.col("top"), chosen)
    return coded.select("doc", "copy", "line", once(F.col("h"), F.col("top"), spots)).select("doc", "copy", "line", "h", *keys)


def shared_blocks(lines: DataFrame) -> DataFrame:
    """key, id, low (least id of the block), n (its lines): for the blocks that several lines share."""
    keyed = lines.select("id", F.explode(F.array(*[c for c in lines.columns if c[0] == "k"])).alias("key")).where("key is not null")
    told = keyed.groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(told, "key").select("key", "id", "low", "n")


def marked(words: Column) -> Column:
    """A string of one character for each word, one of 983,040, so that edit distance counts words."""
    codes = F.transform(words, lambda w: F.hex(F.pmod(w, F.lit(0xF0000)) + 0x10000))
    return F.decode(F.unhex(F.concat(F.lit("000"), F.array_join(codes, "000"))), "UTF-32")


def wanted_lines(docs: DataFrame, lines: DataFrame, shared: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, sim, total, norm of each line that shares a block; only these lines leave their documents."""
    spots = shared.select("id").distinct().join(lines.select("id", "at"), "id").select("id", F.col("at.doc").alias("doc"), F.col("at.copy").alias("copy"), F.col("at.line").alias("line"))
    by_doc = spots.groupBy(F.col("doc").alias("of"), F.col("copy").alias("of_copy")).agg(F.collect_list(F.struct("line", "id")).alias("spots"))
    texts = docs.select(F.col(id_col).alias("doc"), F.col("_copy").alias("copy"), F.col(text_col).alias("text"))
    texts = texts.join(by_doc, F.col("doc").eqNullSafe(F.col("of")) & (F.col("copy") == F.col("of_copy")))
    texts = texts.select("spots", once(F.split("text", "\n").alias("all")))
    texts = texts.select(F.inline(F.transform("spots", lambda s: F.struct(s["id"].alias("id"), F.get("all", s["line"]).alias("raw")))))
    texts = texts.select("id", once(words_of(F.col("raw")).alias("words"))).where(F.xxhash64("words") == F.col("id"))
    texts = texts.select("id", once(F.col("words"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")))
    texts = texts.select("id", simhash(F.col("hashes")).alias("sim"), F.size("words").alias("total"), marked(F.col("words")).alias("norm"))
    # equal rows of a document give a line more than once
    return texts if docs.where("_copy <> 0").isEmpty() else texts.dropDuplicates(["id"])


def within(x: str, y: str, most: str) -> Column:
    """Whether the edit distance is at most ``most``; narrow bands are tried first, as most pairs differ in few places."""
    tries = [F.expr(f"levenshtein({x}, {y}, least({most}, {band})) >= 0") for band in (4, 32)]
    return tries[0] | tries[1] | F.expr(f"{most} > 32 and levenshtein({x}, {y}, {most}) >= 0")


def _most(similarity: float) -> Column:
    return F.floor(F.greatest("total_x", "total_y") * (1 - similarity) + 1e-9).cast("int")


def _may_be_near(budget: int, similarity: float) -> Column:
    """Within the bit budget, and of lengths and words that allow the similarity."""
    apart = lambda c: F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y")))
    longer = F.abs(F.col("total_x") - F.col("total_y"))
    switched = apart("odd0")
    for k in range(1, LANES):
        switched = switched + apart(f"odd{k}")
    return (apart("sim") <= budget) & (longer <= _most(similarity)) & (switched <= 2 * _most(similarity) - longer)


def codes_of(norm: str) -> Column:
    """The numbers of the words in ``norm``, one for each character."""
    return F.transform(F.split(norm, ""), lambda c: F.ascii(c))


def signs(texts: DataFrame) -> DataFrame:
    """id and SIGNS: what is compared before the words themselves."""
    bit = lambda c: F.call_function("shiftleft", _long(1), c.bitwiseAND(F.lit(63)))

    def lane(k: int) -> Column:
        own = F.filter("codes", lambda c: F.shiftright(c, 6).bitwiseAND(F.lit(LANES - 1)) == k)
        return F.aggregate(own, _long(0), lambda x, c: x.bitwiseXOR(bit(c)))

    odd = [lane(k).alias(f"odd{k}") for k in range(LANES)]
    return texts.select("id", "sim", "total", once(codes_of("norm").alias("codes"))).select("id", "sim", "total", *odd)


def _side(texts: DataFrame, end: str, mark: str, *columns: str) -> DataFrame:
    return texts.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{mark}") for c in columns])


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b, most) whose words are at most ``most`` edits apart."""
    both = pairs.join(_side(texts, "a", "x", "norm"), "a").join(_side(texts, "b", "y", "norm"), "b")
    return both.where(within("norm_x", "norm_y", "most")).select("a", "b")


def rare_words(lines: DataFrame, similarity: float) -> DataFrame:
    """id, rare: the first words of each line by rarity (as characters of ``norm``), so many that near lines share one of them."""
    coded = lines.select("id", "total", once(codes_of("norm").alias("codes")))
    # any one order finds all pairs; a rough one, of COUNTED numbers whatever the words, keeps the groups small
    group = lambda c: F.pmod(c, F.lit(COUNTED))
    counted = coded.select(F.explode(F.array_distinct("codes")).alias("code")).groupBy(group(F.col("code")).cast("long").alias("id")).agg(F.count("*").alias("n"))
    counts = lines.sparkSession.range(COUNTED).join(counted, "id", "left").agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "n"))), lambda g: F.coalesce(g["n"], F.lit(0))).alias("counts"))
    ranked = F.sort_array(F.transform("codes", lambda c: F.struct(F.get("counts", group(c)).alias("n"), c.alias("code"))))
    first = F.slice(ranked, 1, F.floor(F.col("total") * (1 - similarity) + 1e-9).cast("int") + 1)
    return coded.crossJoin(F.broadcast(counts)).select("id", F.array_distinct(F.transform(first, lambda w: w["code"])).alias("rare"))


def _pairs_with_rest(rows: DataFrame, key: list[str], near: Column) -> DataFrame:
    """x, y, total_x, total_y of the rows of different groups under one key that may be near, each pair once a key."""
    side = lambda rows, end: rows.select(*key, F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in (*SIGNS, "group", "home")])
    pairs = side(rows, "x").join(side(rows.where("not home"), "y").drop("home_y"), key)
    return pairs.where("group_x <> group_y and (home_x or x < y)").where(near).select("x", "y", "total_x", "total_y")


def first_groups(links: DataFrame) -> DataFrame:
    """id, group: the least line that a line is linked to, in up to four steps; lines of one group are connected, not all
    that are connected are of one group."""
    groups = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("group"))
    for _ in range(2):
        onward = groups.select(F.col("id").alias("group"), F.col("group").alias("next"))
        groups = groups.join(onward, "group", "left").select("id", F.coalesce("next", "group").alias("group"))
    return groups


def mixed_blocks(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """key, n, id, group, home (whether the group is the block's most frequent one): the blocks of several groups."""
    rows = shared.where("n > 2").join(groups, "id", "left").select("key", "n", "id", F.coalesce("group", "id").alias("group"))
    sized = rows.groupBy("key", "group").agg(F.count("*").alias("size"))
    homes = sized.groupBy("key").agg(F.max_by("group", "size").alias("most"), F.count("*").alias("groups")).where("groups > 1")
    return rows.join(homes, "key").select("key", "n", "id", "group", (F.col("group") == F.col("most")).alias("home"))


def line_groups(shared: DataFrame, texts: DataFrame, budget: int, similarity: float) -> DataFrame:
    """id, component of the lines that are near another. Bits and lengths come first, so that words travel for few pairs."""
    near = _may_be_near(budget, similarity)
    told = materialize(signs(texts))
    stars = shared.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    stars = stars.join(_side(told, "a", "x", *SIGNS), "a").join(_side(told, "b", "y", *SIGNS), "b")
    stars = materialize(stars.where(near).select("a", "b", _most(similarity).alias("most")))
    links = materialize(similar(stars, texts))
    rows = materialize(mixed_blocks(shared, first_groups(links)).join(told, "id"))
    discard(stars, told)
    crowded = rows.where(F.col("n") > CROWD)
    rare = rare_words(texts.join(crowded.select("id").distinct(), "id", "left_semi"), similarity)
    crowded = crowded.join(rare, "id").withColumn("word", F.explode("rare")).drop("rare")
    pairs = _pairs_with_rest(rows.where(F.col("n") <= CROWD), ["key"], near).unionByName(_pairs_with_rest(crowded, ["key", "word"], near))
    pairs = materialize(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), _most(similarity).alias("most")).distinct())
    discard(rows)
    groups = connected_components(links.unionByName(similar(pairs, texts)), "a", "b")
    discard(links, pairs)
    return groups


def narrowed(table: DataFrame, *columns: str) -> DataFrame:
    """Some columns of a written table, which is deleted: the blocks are most of it and are needed once."""
    kept = materialize(table.select(*columns))
    discard(table)
    return kept


def removed_lines(docs: DataFrame, budget: int = 24, chosen: int = 11, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, copy, lines array<int>: numbers (from 0) of the lines that go, for each document that loses some."""
    if "_copy" not in docs.columns:
        docs = numbered(docs, id_col, text_col)
    marks = materialize(line_marks(docs, chosen, id_col, text_col))
    keys = [c for c in marks.columns if c[0] == "k"]
    lines = marks.groupBy(F.col("h").alias("id")).agg(F.min(F.struct("doc", "copy", "line")).alias("at"), F.count("*").alias("n"), *[F.first(k).alias(k) for k in keys])
    lines = materialize(lines)
    marks = narrowed(marks, "doc", "copy", "line", "h")
    shared = materialize(shared_blocks(lines))
    lines = narrowed(lines, "id", "at", "n")
    texts = materialize(wanted_lines(docs, lines, shared, id_col, text_col))
    groups = line_groups(shared, texts, budget, similarity)
    discard(shared, texts)

    # the least line of a group has no row of its own
    members = groups.unionByName(groups.select(F.col("component").alias("id"), "component").distinct())
    named = lines.select("id", "at", "n").join(members, "id", "left").where("n > 1 or component is not null")
    named = named.select("id", "at", F.coalesce("component", "id").alias("component"))
    keeper = named.groupBy("component").agg(F.min("at").alias("keep"))
    decided = materialize(named.join(keeper, "component").select(F.col("id").alias("h"), "keep"))
    discard(lines, groups)
    gone = marks.select("doc", "copy", "line", "h").join(decided, "h").where(F.struct("doc", "copy", "line") != F.col("keep"))
    gone = materialize(gone.groupBy("doc", "copy").agg(F.sort_array(F.collect_set("line")).alias("lines")))
    discard(marks, decided)
    return gone


def dedup_lines(docs: DataFrame, budget: int = 24, chosen: int = 11, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` less its removed lines, and n_lines, n_removed in place of any columns of these names."""
    docs = docs.drop("n_lines", "n_removed")
    columns = docs.columns
    # under names of our own, no column of the input can clash
    held = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    held = numbered(held, "id", "text")
    gone = removed_lines(held, budget, chosen, similarity, "id", "text").select(F.col("doc").alias("_doc"), F.col("copy").alias("_of"), F.col("lines").alias("_lines"))
    both = held.join(gone, held["id"].eqNullSafe(gone["_doc"]) & (held["_copy"] == gone["_of"]), "left")
    parts = F.split("text", "\n")
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col("_lines"), i))
    text = F.when(F.col("_lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long")
    n_removed = F.coalesce(F.size("_lines"), F.lit(0)).cast("long")
    others = [F.col("row")[c].alias(c) if c != text_col else text.alias(c) for c in columns]
    return both.select(*others, n_lines.alias("n_lines"), F.when(F.col("text").isNull(), 0).otherwise(n_removed).cast("long").alias("n_removed"))
