"""Fuzzy line dedup: MinHash over character shingles, exact Jaccard, union-find, one line per component.

Everything is a DataFrame or SQL function. Equal lines are one node from the start. The eight-character shingles of a
line are hashed once and sorted; a band is the five least hashes from one of twelve starting points on, going round at
the end (minima under twelve rotations of the hash order). Bands propose pairs, the full sets of shingles confirm them,
and of each component the line that comes first in the corpus stays.

A line with many places where one of a few frequent characters stands takes the shingles that begin there, about one in
five, which is a sample by content and so the same in both of two lines; others take all. In between a line has the
bands of both, so that two similar lines always have bands of one kind.

A line's place is (id, hash of the text, number of the line), so rows that repeat an id, or have none, are told apart by
their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import occupied, release, slot, stored
from creditloom.llm.components import components, settled

#: Characters of a shingle.
WIDTH = 8
#: Jaccard similarity of the shingle sets of two lines that are linked.
SIMILARITY = 0.85
PERCENT = round(100 * SIMILARITY)
#: At the threshold a band differs with probability 1 - 0.85 ** 5; measured, fewer than 1 in 1,000 pairs of similarity 0.85
#: to 0.92 share none, of any length and kind of change. Five hashes keep unlike lines, which share a hundredth of their
#: shingles, out of each other's buckets.
BANDS, ROWS = 12, 5
#: All places of a line from which ``WIDTH`` characters can be taken, and those at one of the sampled characters. A match
#: takes a whole character, so that none begins inside a surrogate pair.
PLACES, SAMPLED = (f"(?s)(?=({c}{'.' * (WIDTH - 1)}))." for c in (".", "[aei3]"))
#: A line of ``LEAST`` sampled places has bands of the sample, one of fewer than ``FEW`` has bands of all places.
LEAST, FEW = 28, 38
#: Starting points of the bands: even numbers, the hashes are odd.
STARTS = [(b * ((1 << 64) // BANDS) & ~1) - (1 << 63) for b in range(BANDS)]
#: Characters on each side of a block of lines that are compared with one another.
BLOCK_CHARS = 1 << 17
#: Rounds in which lines meet one other before blocks are compared.
ROUNDS = 2


def shingles(line: Column) -> Column:
    """Distinct hashes of the shingles of a line of ``WIDTH`` characters or more."""
    return F.array_distinct(F.transform(F.regexp_extract_all(line, F.lit(PLACES), F.lit(1)), lambda piece: F.xxhash64(piece)))


def hashes(line: Column, places: str) -> Column:
    return F.transform(F.regexp_extract_all(line, F.lit(places), F.lit(1)), lambda piece: F.xxhash64(piece).bitwiseOR(F.lit(1)))


def rotations(round_: Column, merged: Column, kind: Column) -> Column:
    """One hash per band over the ``ROWS`` least of the sorted hashes from its starting point on; ``round_`` goes
    round: after the last hash it has the first ``ROWS`` again.

    Hashes are odd and starting points even, and ``merged`` has both sorted: the place of a starting point, less those
    before it, says how many hashes lie below.
    """
    return F.array(*(F.xxhash64(kind, F.lit(i), F.slice(round_, (F.array_position(merged, F.lit(start)) - i).cast("int"), ROWS)) for i, start in enumerate(STARTS)))


def signed(rows: DataFrame, line: str) -> DataFrame:
    """``rows`` with ``kind`` (0 of the sample, 1 of all places) and ``bands`` for each kind that the line has; null for one
    of fewer than ``WIDTH`` characters. ``first_kind`` marks one row of each line.

    The steps are columns one after another, which Spark compiles; inside a lambda it would interpret them.
    """
    sampled = rows.withColumn("_sample", hashes(F.col(line), SAMPLED))
    few = F.size("_sample")
    part = F.when(few >= LEAST, F.struct(F.lit(0).alias("kind"), F.col("_sample").alias("hashes")))
    whole = F.when(few < FEW, F.struct(F.lit(1).alias("kind"), hashes(F.col(line), PLACES).alias("hashes")))
    kinds = sampled.withColumn("_less", few < LEAST).withColumn("_one", F.explode(F.array_compact(F.array(part, whole)))).drop("_sample", line)
    own = kinds.select("*", F.col("_one.kind").alias("kind"), F.sort_array(F.array_distinct("_one.hashes")).alias("_own")).drop("_one")
    # columns of their own, so that each is made once for all bands
    merged = own.withColumn("_merged", F.sort_array(F.concat("_own", F.array(*map(F.lit, STARTS))))).withColumn("_round", F.concat("_own", F.slice("_own", 1, ROWS)))
    found = F.when(F.size("_own") > 0, rotations(F.col("_round"), F.col("_merged"), F.col("kind")))
    return merged.withColumn("bands", found).withColumn("first_kind", (F.col("kind") == 0) | F.col("_less")).drop("_own", "_merged", "_round", "_less")


def lines(docs: DataFrame, id_col: str, text_col: str, shortest: int) -> DataFrame:
    """``(id, hash, line, norm)``: the lines of ``shortest`` characters or more, in lower case, trimmed; ``line`` from 0."""
    text = F.col(text_col).cast("string")
    # the hash below the lines: beside them it would be made of the whole text for every line
    whole = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    split = whole.select("id", "hash", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    return split.select("id", "hash", "line", F.lower(F.trim("raw")).alias("norm")).where(F.length("norm") >= shortest)


def similar(a: Column, b: Column) -> Column:
    """Whether two sets are linked; sizes that can't be are told first. What is shared is named once, as it is made as often
    as it is named."""
    near = F.least(F.size(a), F.size(b)) >= SIMILARITY * F.greatest(F.size(a), F.size(b))
    return near & (F.size(F.array_intersect(a, b)) * (100 + PERCENT) >= PERCENT * (F.size(a) + F.size(b)))


def block_links(live: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components of a bucket, found in blocks of about ``BLOCK_CHARS`` by ``BLOCK_CHARS``.

    A bucket of two lines is settled: they met in the first round. Of buckets that hold the same lines the least is looked
    at, which is where their pairs have their turn. The lines outside a bucket's largest component meet all others. The
    lines of a block are gathered in one row with their sets and compared there, so no row is made for a pair that is no
    link; a pair is looked at in the least band that it shares.
    """
    names = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"name{i}") for i in (0, 1)]
    sizes = live.groupBy("band", "component").agg(F.count("*").alias("count"), F.sum("chars").alias("chars"), *names)
    main = F.max_by(F.struct("component", "count", "chars"), F.struct("count", "component")).alias("main")
    same = [F.bit_xor(f"name{i}").alias(f"name{i}") for i in (0, 1)]
    buckets = sizes.groupBy("band").agg(main, F.sum("count").alias("total"), F.sum("chars").alias("total_chars"), F.count("*").alias("n"), *same)
    several = buckets.where("n > 1 AND total > 2")
    opened = several.groupBy("total", "name0", "name1").agg(F.min(F.struct("band", "main", "total_chars")).alias("least")).select("total", "least.*")

    def parts(count: str, chars: str) -> Column:
        return F.greatest(F.least(F.expr(count), F.ceil(F.expr(chars) / BLOCK_CHARS)), F.lit(1)).cast("int")

    groups = opened.select(
        "band", F.col("main.component").alias("main"), parts("total - main.count", "total_chars - main.chars").alias("outs"), parts("total", "total_chars").alias("ins")
    )
    members = live.select("band", "node", "component").join(groups, "band").join(texts, "node").withColumn("in_main", F.col("component") == F.col("main"))
    place, columns = F.xxhash64("node"), ["band", "i", "j", "outside", "in_main", "node", "component", "bands", "norm"]

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    out = members.where("NOT in_main").withColumn("outside", F.lit(True)).withColumn("i", F.pmod(place, "outs").cast("int")).withColumn("j", every("ins"))
    inside = members.withColumn("outside", F.lit(False)).withColumn("j", F.pmod(place, "ins").cast("int")).withColumn("i", every("outs"))
    both = out.select(columns).union(inside.select(columns))
    gathered = both.groupBy("band", "i", "j").agg(F.collect_list(F.struct(*columns[3:])).alias("members"))

    def partners(x: Column, y: Column) -> Column:
        open_ = (x["component"] != y["component"]) & (y["in_main"] | (x["node"] < y["node"]))
        return open_ & (F.array_min(F.array_intersect(x["bands"], y["bands"])) == F.col("band"))

    def with_set(m: Column) -> Column:
        return F.struct(*(m[f].alias(f) for f in columns[4:8]), shingles(m["norm"]).alias("set"))

    def found(s: Column) -> Column:
        return F.flatten(
            F.transform(
                s["left"],
                lambda x: F.transform(
                    F.filter(s["right"], lambda y: partners(x, y) & similar(x["set"], y["set"])),
                    lambda y: F.struct(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")),
                ),
            )
        )

    # arrays of one element, so that the sides of a block and their sets are made once; only lines with a partner get a set
    whole = F.struct(F.filter("members", lambda m: m["outside"]).alias("left"), F.filter("members", lambda m: ~m["outside"]).alias("right"))
    block = gathered.select("band", F.explode(F.array(whole)).alias("side")).select("band", "side.*")
    outs = F.filter("left", lambda x: F.exists("right", lambda y: partners(x, y)))
    ins = F.filter("right", lambda y: F.exists("left", lambda x: partners(x, y)))
    sides = F.array(F.struct(F.transform(outs, with_set).alias("left"), F.transform(ins, with_set).alias("right")))
    pairs = block.select(F.explode(F.flatten(F.transform(sides, found))).alias("pair"))
    return pairs.select("pair.a", "pair.b").distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 1) -> DataFrame:
    """``(id, hash, removed)``: for each document the numbers of its lines that go."""
    place = F.struct("id", "hash", "line")
    all_lines = lines(docs, id_col, text_col, shortest)
    named = all_lines.withColumn("digest", F.unhex(F.md5(F.col("norm").cast("binary"))))
    rows = signed(named.select("digest", place.alias("place"), F.length("norm").alias("chars"), "norm"), "norm")
    of = [F.first(F.when(F.col("kind") == k, F.col("bands")), ignorenulls=True).alias(f"bands{k}") for k in (0, 1)]
    grouped = rows.groupBy("digest").agg(F.min("place").alias("place"), *of, F.first("chars").alias("chars"), F.count_if("first_kind").alias("count"))
    both = F.concat(*(F.coalesce(f"bands{k}", F.array().cast("array<bigint>")) for k in (0, 1)))
    banded = stored(grouped.select("digest", "place", both.alias("bands"), "chars", "count", F.monotonically_increasing_id().alias("node")))  # numbers hold once written
    # one exchange for both the sizes and the rows
    buckets = banded.select("node", F.explode("bands").alias("band")).repartition("band")
    shared = buckets.groupBy("band").agg(F.count("node").alias("size")).where("size > 1")
    sized = stored(buckets.join(shared.hint("shuffle_hash"), "band"))
    # of the bands only those that another line has are needed from here on, and of few lines
    own = sized.groupBy("node").agg(F.sum("size").alias("degree"), F.collect_list("band").alias("bands"))
    near = stored(own.hint("shuffle_hash").join(banded.select("node", "digest", "place", "chars", "count"), "node"))
    live = stored(sized.select("band", "node").join(near.select("node", "degree", "chars"), "node").withColumn("component", F.col("node")))
    release(sized)
    again = stored(banded.where("count > 1").select("digest", "place", "node"))
    release(banded)

    spot = F.struct("node", "place.line", "bands")
    wanted = near.groupBy("place.id", "place.hash").agg(F.collect_list(spot).alias("wanted"))
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("_id"), text.alias("text"), F.xxhash64(text).alias("_hash")).withColumn("slot", slot("_hash"))
    owners = source.join(occupied(wanted, "hash"), "slot", "left_semi")
    found = wanted.hint("shuffle_hash").join(owners, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")))
    # split below the lambda, which would do it again for each line
    parted = found.select("wanted", F.explode(F.array(F.split("text", "\n"))).alias("cut"))
    one = F.transform("wanted", lambda w: F.struct(w["node"].alias("node"), w["bands"].alias("bands"), F.lower(F.trim(F.col("cut")[w["line"]])).alias("norm")))
    texts = stored(parted.select(F.explode(one).alias("one")).select("one.*").dropDuplicates(["node"]))  # rows that repeat id and text

    def confirm(pairs: DataFrame) -> DataFrame:
        first, second = texts.select(F.col("node").alias("a"), F.col("norm").alias("x")), texts.select(F.col("node").alias("b"), F.col("norm").alias("y"))
        sets = F.struct(shingles(F.col("x")).alias("x"), shingles(F.col("y")).alias("y"))
        # out of an array of one element, so that the sets of a pair are made once
        made = pairs.join(first, "a").join(second, "b").select("a", "b", F.explode(F.array(sets)).alias("sets"))
        return made.where(similar(F.col("sets.x"), F.col("sets.y"))).select("a", "b")

    edges = settled(live, confirm, lambda open_: block_links(open_, texts), ROUNDS)
    release(texts)
    # only lines that occur again, or are like an earlier one, can go
    alone = again.select("digest", "node", F.col("place").alias("keep"))
    if edges is not None:
        labels = components(edges).withColumnRenamed("id", "node")
        linked = near.select("digest", "place", "count", "node").join(labels, "node")
        first = linked.groupBy("component").agg(F.min("place").alias("keep"))
        later = linked.join(first, "component").where("count > 1 OR place <> keep").select("digest", "keep")
        going = stored(later.unionByName(alone.join(labels, "node", "left_anti").select("digest", "keep")))
    else:
        going = stored(alone.select("digest", "keep"))
    release(near, again)
    every = named.select("digest", place.alias("place")).withColumn("slot", slot("digest")).join(occupied(going, "digest"), "slot", "left_semi")
    gone = every.join(going.hint("shuffle_hash"), "digest").where("place <> keep").select("place.*")
    return gone.groupBy("id", "hash").agg(F.collect_set("line").alias("removed"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "n_removed", shortest: int = 1) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text_col``, and their number in ``removed_col``.

    Lines are compared in lower case without outer blanks. Those of fewer than ``WIDTH`` characters have no shingles and
    are repeats of equal ones only; those below ``shortest`` stay, with 1 just blank lines, which part paragraphs. Of each
    component of lines the first stays, by id (null first), hash of the text and number. Rows equal in id and text are
    one document and are cut alike. A null text stays null. All other columns stay; one named ``removed_col`` is
    replaced. An empty table gives an empty result.
    """
    removed = stored(repeated_lines(docs, id_col, text_col, shortest))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    id_, text = F.col("row").getField(id_col), F.col("row").getField(text_col).cast("string")
    marked = rows.withColumn("key", F.xxhash64(text)).withColumn("slot", slot("key"))
    slots = occupied(removed, "hash")
    untouched = marked.join(slots, "slot", "left_anti").withColumn("removed", F.lit(None).cast("array<int>"))
    maybe = marked.join(slots, "slot", "left_semi").join(removed.hint("shuffle_hash"), id_.eqNullSafe(F.col("id")) & (F.col("key") == F.col("hash")), "left")
    # split below the lambda, which would do it again for each line
    parted = maybe.select("row", "removed", F.explode(F.array(F.when(F.col("removed").isNotNull(), F.split(text, "\n")))).alias("parts"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("removed"))
    joined = F.array_join(F.transform(staying, lambda i: F.col("parts")[i]), "\n")
    cut = parted.select("row", "removed", F.when(F.col("removed").isNull(), text).otherwise(joined).alias("text"))
    count = F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long")
    both = untouched.select("row", "removed", text.alias("text")).unionByName(cut)
    columns = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c != removed_col]
    return both.select(*columns, count.alias(removed_col))
