"""Line dedup by a segment-partition edit join, in DataFrame functions throughout.

Two lines within two edits of each other have at least one of three segments in common, cut by
the length of the shorter line: its beginning, its end, or what lies between. Every line enters
its three segments in an index and probes it with the substrings that a line up to two characters
shorter could share: beginning and end lie where they lay, the middle may have moved by one. What
meets is verified by a banded bit-parallel edit distance.

Lines travel as 64-bit hashes; only the text of lines that meet another one is moved. Copies of a
line are one entry of the index from the map side on. A line only has to find one earlier near line,
so it is first compared with the earliest of each of its segments, which takes as many comparisons as
the line has segments. Lines found late need no further earlier line: what is left to compare are
pairs whose later line was not found so. Segments in which many such lines are left give no pairs:
those lines are joined by halves, of which two lines within two edits share one as well, again with
the earliest one first, and what then is left in tiles of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plateflow.llm.frames import column, kept, scratch, stored
from plateflow.session import cut

#: Most edits between lines that count as one; the three segments rest on it.
EDITS = 2
#: One edit is allowed for every so many characters of the shorter line, so short lines must be equal.
CHARACTERS = 12
#: Bits for each line that is fetched, in an array that every task has; beyond ``MOST_MARKED`` lines they are joined.
MARK_FACTOR, MOST_MARKED = 16, 1 << 22
#: Lines left in a segment, not found late, that are paired by it; more of them are paired by halves.
CROWD = 32
#: Lines of a half that are compared in one task with another line.
TILE = 512
#: Pieces of a line of which all but ``EDITS`` must reappear; a cheap sieve before the distance.
PIECES = 8


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, t, no (from 0), line, h: the lines of each text that are not blank; t and h are hashes of text and line."""
    every = docs.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    every = every.filter("trim(line) != ''")
    return every.withColumn("h", F.xxhash64("line"))


def _dated(lines: DataFrame) -> DataFrame:
    """With ``d``, by which lines are ordered as by their first document; the same for all if doc_id is no whole number."""
    number = isinstance(lines.schema["doc_id"].dataType, T.IntegralType)
    return lines.withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))) if number else F.lit(0).cast("long"))


def _step(length: Column) -> Column:
    return F.floor(length / 16) * 16


def _thirds(length: Column) -> Column:
    """Characters of the first and the last segment of a line of that length."""
    return F.greatest(F.lit(4), F.floor(_step(length) / 3).cast("int"))


def _quarters(length: Column) -> Column:
    return F.greatest(F.lit(3), F.floor(_step(length) / 4).cast("int"))


def _segments(lines: DataFrame, indexed: bool) -> DataFrame:
    """(key, h, n, d): the three segments of every line, or all substrings it could share one as.

    A key holds the length of the indexed line, so that lines meet only where their lengths allow it.
    """
    n, line = F.col("n"), F.col("line")
    wide = lines.select("h", "d", "line", F.length("line").alias("n")).filter(F.col("n") >= CHARACTERS)
    wide = wide.withColumns({f"s{e}": _thirds(n - e) for e in ((0,) if indexed else range(EDITS + 1))})

    def keys(shorter: int) -> list[Column]:
        size, length = F.col(f"s{shorter}"), n - shorter
        moves = (0,) if indexed else [m for m in (-1, 0, 1) if abs(shorter - m) <= 1]
        own = [F.xxhash64(F.lit(0), length, F.substr(line, F.lit(1), size)),
               F.xxhash64(F.lit(1), length, F.substr(line, n - size + 1, size))]
        own += [F.xxhash64(F.lit(2), length, F.substr(line, size + 1 + moved, length - 2 * size)) for moved in moves]
        return own if shorter == 0 else [F.when(length >= CHARACTERS, k) for k in own]

    every = [k for shorter in range(1 if indexed else EDITS + 1) for k in keys(shorter)]
    return wide.select(F.explode(F.array(*every)).alias("key"), "h", "n", "d").filter("key is not null")


def _halves(lines: DataFrame, indexed: bool) -> DataFrame:
    """(key, h, n, d, first, line): as ``_segments``, by what amounts to half of a line each.

    Of four quarters, counted from both ends, two edits leave two alone: the first two, the last
    two, the first and the last; or, where one edit is in either half, the inner ones moved by one
    at most, the last and the second, or the first and the third.
    """
    n, line = F.col("n"), F.col("line")
    wide = lines.select("h", "d", "first", "line", F.length("line").alias("n")).filter(F.col("n") >= CHARACTERS)
    wide = wide.withColumns({"q0": _quarters(n), "q2": _quarters(n - EDITS)})

    def part(start: Column, size: Column) -> Column:
        return F.substr(line, start, size)

    def keys(q: Column, moves: tuple[int, ...]) -> list[Column]:
        one = F.lit(1)
        left, right = part(one, q), part(n - q + 1, q)
        out = [F.xxhash64(F.lit(3), q, part(one, 2 * q)), F.xxhash64(F.lit(4), q, part(n - 2 * q + 1, 2 * q)),
               F.xxhash64(F.lit(5), q, left, right)]
        for moved in moves:
            out += [F.xxhash64(F.lit(6), q, part(q + 1 + moved, 2 * q)),
                    F.xxhash64(F.lit(7), q, right, part(q + 1 + moved, q)),
                    F.xxhash64(F.lit(8), q, left, part(n - 2 * q + 1 + moved, q))]
        return out

    every = keys(F.col("q0"), (0,) if indexed else (-1, 0, 1))
    if not indexed:
        every += [F.when(F.col("q2") != F.col("q0"), k) for k in keys(F.col("q2"), (-1, 0, 1))]
    return wide.select(F.explode(F.array_distinct(F.array(*every))).alias("key"), "h", "n", "d", "first", "line").filter("key is not null")


def _fetched(lines: DataFrame, ids: DataFrame, path: str) -> DataFrame:
    """(h, d, line) once for each of the hashes ``h`` (and for a few others)."""
    ids = stored(ids.select("h").distinct(), f"{path}-ids")
    n = ids.count()
    if n <= MOST_MARKED:
        bits = max(16, (n * MARK_FACTOR).bit_length())
        some = lines.filter(_marked(F.col("h"), _marks(ids, bits), bits))
    else:
        some = lines.join(ids, "h", "left_semi")
    return stored(some.groupBy("h").agg(F.min("d").alias("d"), F.min("line").alias("line")), path)


def _order(p: str, i: str) -> Column:
    """Whether probe ``p`` and indexed line ``i`` are a pair to compare: longer by up to the edits, equal lengths one way round."""
    longer = F.col(f"{p}.n") - F.col(f"{i}.n")
    return longer.between(0, EDITS) & ((longer > 0) | (F.col(f"{p}.h") > F.col(f"{i}.h"))) & (F.col(f"{p}.h") != F.col(f"{i}.h"))


def _left(p: str, i: str) -> Column:
    """Whether the later of the two may be one that was not found late."""
    earlier = F.col(f"{p}.d") < F.col(f"{i}.d")
    later = F.col(f"{p}.d") > F.col(f"{i}.d")
    return ~(earlier & F.col(f"{i}.late")) & ~(later & F.col(f"{p}.late")) & ~(F.col(f"{p}.late") & F.col(f"{i}.late"))


def _flagged(rows: DataFrame, late: DataFrame) -> DataFrame:
    return rows.join(late.withColumn("late", F.lit(True)), "h", "left").withColumn("late", F.coalesce("late", F.lit(False)))


def _later(a: str, b: str) -> Column:
    """Of two lines the one that comes first later."""
    return F.when(F.col(f"{a}.first") > F.col(f"{b}.first"), F.col(f"{a}.h")).otherwise(F.col(f"{b}.h")).alias("h")


def _late(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(h): the later line of those pairs (long, short) that are within the edits their length allows."""
    a, b = known.select("h", "first", "line").alias("a"), known.select("h", "first", "line").alias("b")
    both = pairs.distinct().join(a, F.col("long") == F.col("a.h")).join(b, F.col("short") == F.col("b.h"))
    return both.filter(_near(F.col("a.line"), F.col("b.line"))).select(_later("a", "b")).distinct()


def _sieve(long: Column, short: Column) -> Column:
    """Whether all but ``EDITS`` pieces of ``short`` are in ``long``, moved by ``EDITS`` at most."""
    size = F.floor(F.length(short) / PIECES).cast("int")
    found = F.lit(0)
    for k in range(PIECES):
        at = size * k + 1
        begin = F.greatest(F.lit(1), at - EDITS)
        window = F.substr(long, begin, at + size + EDITS - begin)
        found = found + F.contains(window, F.substr(short, at, size)).cast("int")
    return found >= PIECES - EDITS


def edit_distance(long: Column, short: Column, most: int = EDITS) -> Column:
    """Edit distance of two strings, ``long`` being longer by 0 to ``most`` characters; above ``most``: any larger number.

    Bit i of the vectors stands for row j - most + i of column j, so a band of 2 * most + 1 rows
    follows the diagonal. Bits of ``vp`` and ``vn`` say where a value is one more or one less than
    the one above; ``d0`` where it equals the one diagonally above. Rows above the first one count
    down to it, and rows that enter below count on, so values in the band are never too small,
    and they are exact up to ``most``.
    """
    width = 2 * most + 1
    full = F.lit((1 << width) - 1).cast("long")
    apart = F.length(long) - F.length(short)

    def bits(value: int) -> Column:
        return F.lit(value).cast("long")

    def no(x: Column) -> Column:
        return F.bitwise_not(x).bitwiseAND(full)

    def step(line: Column, state: Column, j: Column) -> Column:
        a, letter, apart = line["a"], F.get(line["b"], j - 1), line["apart"]
        pm = bits(0)
        for i in range(width):
            same = F.coalesce(F.get(a, j - most + i - 1) == letter, F.lit(False))
            pm = pm + F.when(same, bits(1 << i)).otherwise(bits(0))
        vp = F.shiftright(state["vp"], 1).bitwiseOR(bits(1 << (width - 1)))
        vn = F.shiftright(state["vn"], 1)
        prepared = F.struct(pm.alias("pm"), vp.alias("vp"), vn.alias("vn"))

        def advance(x: Column) -> Column:
            d0 = (x["pm"].bitwiseAND(x["vp"]) + x["vp"]).bitwiseXOR(x["vp"]).bitwiseOR(x["pm"]).bitwiseOR(x["vn"]).bitwiseAND(full)
            return F.struct(d0.alias("d0"), x["vp"].alias("vp"), x["vn"].alias("vn"))

        def close(x: Column) -> Column:
            up = F.shiftleft(x["vn"].bitwiseOR(no(x["d0"].bitwiseOR(x["vp"]))), 1).bitwiseOR(bits(1)).bitwiseAND(full)
            down = F.shiftleft(x["d0"].bitwiseAND(x["vp"]), 1).bitwiseAND(full)
            # The last cell lies on the diagonal of bit most + apart; a set bit there costs nothing.
            even = F.call_function("shiftright", x["d0"], apart + most).bitwiseAND(bits(1))
            return F.struct(down.bitwiseOR(no(x["d0"].bitwiseOR(up))).alias("vp"), x["d0"].bitwiseAND(up).alias("vn"),
                            (state["distance"] + 1 - even).cast("long").alias("distance"))

        # One-element arrays name a value that is used more than once.
        named = F.transform(F.transform(F.array(prepared), advance), close)
        return F.when(state["distance"] > most, state).otherwise(F.element_at(named, 1))

    start = F.struct(bits(((1 << most) - 1) << (most + 1)).alias("vp"), bits((1 << (most + 1)) - 1).alias("vn"),
                     apart.cast("long").alias("distance"))
    def distance(line: Column) -> Column:
        size = F.size(line["b"])
        steps = F.when(line["empty"], F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), size))
        return F.aggregate(steps, start, lambda state, j: step(line, state, j))["distance"]

    # A one-element array names what every step uses, so that it is made once.
    line = F.struct(F.split(long, "").alias("a"), F.split(short, "").alias("b"), apart.alias("apart"),
                    (F.length(short) == 0).alias("empty"))
    return F.when(apart.between(0, most), F.element_at(F.transform(F.array(line), distance), 1)).otherwise(
        F.lit(most + 1).cast("long"))


def _marks(values: DataFrame, bits: int) -> Column:
    """An array of 2**bits bits, as longs, in which the top bits of every ``h`` are set."""
    place = F.shiftrightunsigned("h", 64 - bits)
    words = values.select(F.shiftright(place, 6).alias("id"), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    words = words.groupBy("id").agg(F.bit_or("bit").alias("bits"))
    every = values.sparkSession.range(1 << (bits - 6)).join(words, "id", "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    listed = every.agg(F.sort_array(F.collect_list(F.struct("id", "bits"))).alias("x"))
    return listed.select(F.transform("x", lambda e: e["bits"]).alias("x")).scalar()


def _near(long: Column, short: Column) -> Column:
    """Whether two lines are within the edits that the length of the shorter allows.

    The pieces that both have in common at their beginning and at their end are cut off first:
    that leaves the distance as it is, and little to go through.
    """
    size = F.floor(F.length(short) / PIECES).cast("int")

    def most(same, room: Column) -> Column:
        chain = F.when(F.lit(False), 0)
        for k in range(PIECES, 0, -1):
            chain = chain.when((room >= k) & same(size * k), k)
        return chain.otherwise(0)

    lead = most(lambda n: F.substr(long, F.lit(1), n) == F.substr(short, F.lit(1), n), F.lit(PIECES))

    def trail(room: Column) -> Column:
        return most(lambda n: F.substr(long, F.length(long) - n + 1, n) == F.substr(short, F.length(short) - n + 1, n), room)

    def core(x: Column) -> Column:
        gone = (x["lead"] + x["trail"]) * size
        return F.struct(F.substr(long, x["lead"] * size + 1, F.length(long) - gone).alias("long"),
                        F.substr(short, x["lead"] * size + 1, F.length(short) - gone).alias("short"))

    # One-element arrays name what is used more than once.
    ends = F.transform(F.array(lead), lambda n: F.struct(n.alias("lead"), trail(F.lit(PIECES) - n).alias("trail")))
    allowed = F.least(F.lit(EDITS), F.floor(F.length(short) / CHARACTERS))
    near = F.transform(F.transform(ends, core), lambda x: edit_distance(x["long"], x["short"]) <= allowed)
    return _sieve(long, short) & F.element_at(near, 1)


def _marked(h: Column, marks: Column, bits: int) -> Column:
    """Whether the bit of hash ``h`` is set."""
    place = F.shiftrightunsigned(h, 64 - bits)
    word = F.get(marks, F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def late_lines(lines: DataFrame, first: DataFrame, folder: str) -> DataFrame:
    """(h): lines that have a different line within the edits that their length allows before them.

    ``lines`` has h, d and line for every place of a line; ``first`` (h, first) says where each comes first.
    """
    index = _segments(lines, True).groupBy("key", "h").agg(F.min("n").alias("n"), F.min("d").alias("d"))
    index = stored(index, f"{folder}/index")
    # The earliest line of each segment, and how many lines have it.
    hubs = index.groupBy("key").agg(F.min(F.struct("d", "h", "n")).alias("hub"), F.count(F.lit(1)).alias("c"))
    met = _segments(lines, False).join(hubs, "key").filter((F.col("hub.h") != F.col("h")) | (F.col("c") > 1))
    met = stored(met.groupBy("key", "h").agg(F.min("n").alias("n"), F.min("d").alias("d"), F.first("hub").alias("hub"),
                                             F.first("c").alias("c")), f"{folder}/met")
    # Of the lines that meet another one text and place are fetched, once.
    meeting = met.select("h").union(met.select("hub.h"))
    known = _fetched(lines, meeting, f"{folder}/text").join(first, "h")
    known = stored(known, f"{folder}/known")
    late = stored(_late(met.filter(F.col("hub.h") != F.col("h")).select(F.col("h").alias("long"), F.col("hub.h").alias("short")), known),
                  f"{folder}/late1")

    # What is left: pairs of a segment whose later line was not found late.
    probes = stored(_flagged(met.filter("c > 1").select("key", "h", "n", "d", F.col("hub.h").alias("hub"), "c"), late), f"{folder}/probes")
    keys = probes.groupBy("key").agg(F.count(F.when(~F.col("late"), 1)).alias("left"), F.max("c").alias("c"))
    keys = stored(keys.withColumn("crowded", (F.col("left") > CROWD) & (F.col("c") > CROWD)), f"{folder}/keys")
    entries = stored(_flagged(index.join(keys.select("key", "crowded"), "key"), late), f"{folder}/entries")
    p, i = probes.join(keys.filter("not crowded").select("key"), "key", "left_semi"), entries.filter("not crowded")
    more = [a.alias("p").join(b.alias("i"), (F.col("p.key") == F.col("i.key")) & _order("p", "i") & _left("p", "i")
                              & (F.col("i.h") != F.col("p.hub"))).select(F.col("p.h").alias("long"), F.col("i.h").alias("short"))
            # Apart, so that lines found late never meet each other.
            for a, b in ((p.filter("not late"), i), (p.filter("late"), i.filter("not late")))]
    late = stored(late.union(_late(more[0].union(more[1]), known)).distinct(), f"{folder}/late2")

    crowd = probes.join(keys.filter("crowded").select("key"), "key", "left_semi").select("h").union(
        entries.filter("crowded").select("h")).distinct()
    many = stored(known.join(crowd, "h", "left_semi"), f"{folder}/crowd")
    return stored(late.union(_crowded(many, late, folder)).distinct(), f"{folder}/late")


def _crowded(lines: DataFrame, late: DataFrame, folder: str) -> DataFrame:
    """(h): late lines among those of crowded segments, by halves; rows carry their text, so only near pairs leave a join."""
    near = _near(F.col("p.line"), F.col("i.line"))
    index = stored(_halves(lines, True), f"{folder}/halves")
    hubs = index.groupBy("key").agg(F.min(F.struct("d", "h", "n", "first", "line")).alias("hub"), F.count(F.lit(1)).alias("c"))
    hubs = stored(hubs.select("key", "hub.*", "c"), f"{folder}/hubs")
    once = _halves(lines, False).alias("p").join(hubs.alias("i"), (F.col("p.key") == F.col("i.key")) & _order("p", "i") & near)
    late = stored(late.union(once.select(_later("p", "i"))).distinct(), f"{folder}/late3")
    # The lines of a half are dealt to tiles; a line that asks goes to each of them.
    sizes = hubs.filter("c > 1").select("key", F.call_function("div", F.col("c") - 1, F.lit(TILE)).alias("tiles"), F.col("h").alias("hub"))
    entries = _flagged(index, late).join(sizes, "key").withColumn("tile", F.pmod(F.col("h"), F.col("tiles") + 1))
    asking = _flagged(_halves(lines, False), late).join(sizes, "key").withColumn(
        "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles"))))
    pairs = [a.alias("p").join(b.alias("i"), (F.col("p.key") == F.col("i.key")) & (F.col("p.tile") == F.col("i.tile")) & _order("p", "i")
                               & _left("p", "i") & (F.col("i.h") != F.col("p.hub")) & near).select(_later("p", "i"))
             for a, b in ((asking.filter("not late"), entries), (asking.filter("late"), entries.filter("not late")))]
    return late.union(pairs[0]).union(pairs[1])


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of the text), gone (line numbers), near, exact: which lines to leave out, and how many.

    ``docs`` has ``doc_id`` and ``text``. A line goes if an equal one, or a different one within
    the allowed edits, comes before it by (doc_id, line number); that one may itself be left out.
    """
    with scratch(docs.sparkSession) as folder:
        places = stored(_lines(docs).select("doc_id", "t", "no", "h", F.xxhash64(F.lit(1), "line").alias("h2")), f"{folder}/places")
        lines = places.groupBy("h", "h2").agg(F.min(F.struct("doc_id", "t", "no")).alias("first"), F.count(F.lit(1)).alias("times"))
        lines = stored(lines, f"{folder}/lines")
        late = late_lines(_dated(_lines(docs)), lines.select("h", "first"), folder)
        # The other lines occur once and are near none before them.
        state = lines.join(late.withColumn("near", F.lit(True)), "h", "left").filter("near or times > 1").select(
            "h", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
        seen = places.join(state, ["h", "h2"])
        repeat = ~F.struct("doc_id", "t", "no").eqNullSafe(F.col("first"))
        gone = seen.filter(repeat | F.col("near")).select("doc_id", "t", "no", (~repeat).alias("near"))
        # Rows that are equal have each place once.
        gone = gone.groupBy("doc_id", "t").agg(F.collect_set(F.struct("no", "near")).alias("gone"))
        near = F.size(F.filter("gone", lambda x: x["near"])).cast("long")
        return cut(gone.select("doc_id", "t", F.transform("gone", lambda x: x["no"]).alias("gone"), near.alias("near"),
                               (F.size("gone") - near).alias("exact")))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] | list[str] = ("doc_id",)) -> DataFrame:
    """The documents without lines that repeat an earlier line, of any document, exactly or nearly.

    Returns the ``keep`` columns, ``text`` (the lines that stay, in order), ``n_lines`` and
    ``n_kept`` (blank lines count in both), ``n_exact`` and ``n_near`` (lines left out), all long.
    Lines end at line feeds; order is by doc_id (null first) and line number. Two lines are near
    within two edits, one for every ``CHARACTERS`` characters of the shorter, so lines of fewer
    must be equal. A line goes if such a line comes before it, also where that one goes as well.
    Blank lines stay. A null text stays null with no lines; an empty one has one blank line. Rows
    equal in doc_id and text are one document; others that share a doc_id follow by the hash of
    their text. An empty table gives an empty result. Kept columns named like an output are replaced.
    """
    outputs = ("text", "n_lines", "n_kept", "n_exact", "n_near")
    names = [f"d{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    frame = docs.toDF(*names)
    slim = frame.select(F.col(at[doc_id]).alias("doc_id"), F.col(at[text]).alias("text"))
    lines = dropped_lines(slim).withColumnRenamed("doc_id", "of")
    joined = frame.join(lines, F.col(at[doc_id]).eqNullSafe(F.col("of")) & (F.xxhash64(at[text]) == F.col("t")), "left")
    value, zero = F.col(at[text]), F.lit(0).cast("long")
    number = F.octet_length(value) - F.octet_length(F.replace(value, F.lit("\n"), F.lit(""))) + 1
    # A one-element array names the lines, so that a text is split once.
    cleaned = F.when(F.col("gone").isNull(), value).otherwise(F.element_at(F.transform(
        F.array(F.split(value, "\n")), lambda every: F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("gone")), lambda i: F.get(every, i)), "\n")), 1))
    n_lines = F.coalesce(number.cast("long"), zero)
    n_kept = n_lines - F.when(F.col("gone").isNull(), zero).otherwise(F.size("gone").cast("long"))
    carry = kept(list(keep), outputs)
    return joined.select(*[column(joined, at[c]).alias(c) for c in carry], cleaned.alias("text"), n_lines.alias("n_lines"),
                         n_kept.alias("n_kept"), F.coalesce("exact", zero).alias("n_exact"), F.coalesce("near", zero).alias("n_near"))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with their text deduped and ``n_chars``, if they have it, counted anew; other columns as they were.

    A document of which nothing but blank lines is left goes, if a line was taken from it.
    """
    names = [f"d{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    found = dedup(docs.toDF(*names), at[doc_id], at[text], keep=names)
    taken = F.col("n_exact") + F.col("n_near") > 0
    found = found.filter(~taken | (F.trim(F.replace("text", F.lit("\n"), F.lit(" "))) != "")).withColumn(at[text], F.col("text"))
    if n_chars in at:
        count = F.length("text").cast(docs.schema[n_chars].dataType)
        found = found.withColumn(at[n_chars], F.when(taken, count).otherwise(F.col(at[n_chars])))
    return found.select(*names).toDF(*docs.columns)
