"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line, or a sentence of one (up to any script's stop, a colon or a
semicolon).  Long ones fall into pieces: the first ``FIRST`` units, then at each unit
whose hash is 0 modulo ``EVERY``, or after ``LONGEST`` units without such.  A unit is
a letter of a script without spaces, else a word or a part of one, of ``UNIT`` characters at most.
Of a long document's pieces the first ``SINGLE`` stand alone, the others in groups that
end at a piece whose hash is 0 modulo ``GROUP`` (or after ``LONGEST_GROUP`` pieces).
So a part that an edit leaves alone keeps its pieces and groups.  A document is the set
of their 64-bit digests.  A sketch has cells in three equal parts; each digest
is added to one cell of each part: a count, the XOR of the digests and the XOR of
their checks.  Sketches of two versions subtract cell by cell, so what both have
vanishes; a cell with one digest left (count of 1 or -1, and check in order) gives
it away, it is taken out of its other cells, and so on.

Where cells remain, the sketch was too small, and a larger one is tried, or 4 or 16 in
its place, by further bits of the digests' hash, as its cells' counts suggest, and so on
for those that still fail.  A sketch whose two versions differ
by more than it can hold - in number, or by that estimate - is known to fail and
is split at once.  What still remains after ``LEVELS`` levels (digests that agree in at
least 24 bits of their hash) is compared digest by digest.

The likeness of two versions is  common / (common + only here + only there),
1 where both are empty.  The fingerprint is the first sketch in hexadecimal.

Null texts count as empty and have no paragraphs; an empty table gives no row.  Rows that
repeat a doc_id are ordered by a hash of their text and then by text; rows without one
come after all others, in the same order.  Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NULL_ID, ids_and_texts, partitions

#: Cells of a part of the first sketch, the fingerprint, and of the larger ones.
PART, LARGE = 6, 16
LEVELS = 12
#: Differing digests that a small sketch is expected to give away.
FEW = 9
#: The cell columns of a placed digest, by the size of a part.
COLUMNS = {PART: "xyz", LARGE: "uvw"}
#: Units of a paragraph's first piece, about and at most of its further ones; characters of a unit.
FIRST, EVERY, LONGEST, UNIT = 24, 48, 128, 32
#: Pieces of a document that stand alone; pieces of a group, about and at most.
SINGLE, GROUP, LONGEST_GROUP = 16, 8, 64
#: Stops that end a paragraph without white space behind them.
_FULL_STOPS = "。！？｡．：；"
_SPACE = r"[ \t\n\x0B\f\r]"
#: The white space comes first: there is less of it than of places behind a stop.
_BREAK = rf"\n+|{_SPACE}(?<=[.?!:;…؟؛۔।॥།։]{_SPACE})\s*"
#: Letters of the scripts that set no spaces between words; most other text is in ``_PLAIN``.
_ALONE = r"฀-໿က-႟ក-៿⺀-ㇿ㐀-鿿豈-﫿ｦ-ﾟ\x{20000}-\x{3FFFF}"
_PLAIN = r"!-෿"
_WORDS = rf"\s*+(?:[{_PLAIN}]{{1,{UNIT}}}+|[{_ALONE}]|[^\s{_PLAIN}{_ALONE}]{{1,{UNIT}}}+)"
_UNIT, _LONG = rf"{_WORDS}|\s+$", rf"^(?:{_WORDS}){{{FIRST + 1}}}"


def let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def cells_of(digest: str, part: int) -> dict[str, str]:
    """SQL: a digest k, its check h and its cell in each part."""
    cells = {c: f"cast({n * part} + pmod(xxhash64({digest}, {n + 1}), {part}) as int)" for n, c in enumerate(COLUMNS[part])}
    return {"k": digest, "h": f"xxhash64({digest}, 99)"} | cells


def pieces(paragraph: str) -> str:
    """SQL: the pieces of a paragraph, which together give it again."""
    ends = f"filter(sequence(1, size(us)), i -> i = {FIRST} or (i > {FIRST} and pmod(xxhash64(trim(us[i - 1])), {EVERY}) = 0) or i = size(us))"
    # From a piece's end to the next one, in steps of at most LONGEST units.
    steps = f"flatten(transform(es, (e, n) -> sequence(if(n = 0, 0, es[n - 1]), e - 1, {LONGEST})))"
    cut = "transform(ss, (s, n) -> array_join(slice(us, s + 1, coalesce(get(ss, n + 1), size(us)) - s), ''))"
    all_units = f"regexp_extract_all({paragraph}, r'{_UNIT}', 0)"
    long = let(ends, "es", let(steps, "ss", cut))
    return f"if({paragraph} rlike r'{_LONG}', {let(all_units, 'us', long)}, array({paragraph}))"


def digests(text: str) -> str:
    """SQL: the digests of a text's pieces and groups of pieces, each once."""
    # Fewer characters cannot be more than FIRST units.
    cut = f"if(char_length(u) <= {FIRST}, array(u), {pieces('u')})"
    full = " or ".join(f"contains({text}, '{c}')" for c in _FULL_STOPS)
    split = f"if({full}, split({text}, r'{_BREAK}|(?<=[{_FULL_STOPS}])\\s*'), split({text}, r'{_BREAK}'))"
    each = f"transform(flatten(transform(filter({split}, u -> u <> ''), u -> {cut})), u -> xxhash64(u))"
    ends = f"filter(sequence(1, size(ds)), i -> i <= {SINGLE} or pmod(ds[i - 1], {GROUP}) = 0 or i = size(ds))"
    # From a group's end to the next one, in steps of at most LONGEST_GROUP pieces.
    steps = f"flatten(transform(es, (e, n) -> sequence(if(n = 0, 0, es[n - 1]), e - 1, {LONGEST_GROUP})))"
    joined = "transform(ss, (s, n) -> xxhash64(slice(ds, s + 1, coalesce(get(ss, n + 1), size(ds)) - s)))"
    grouped = let(ends, "es", let(steps, "ss", joined))
    return let(each, "ds", f"array_distinct(if(size(ds) <= {SINGLE}, ds, concat(slice(ds, 1, {SINGLE}), slice({grouped}, {SINGLE + 1}, size(ds)))))")


def items(digest_array: str) -> str:
    """SQL: digests with their cells in both sizes, and g to choose among several sketches."""
    return f"transform({digest_array}, d -> {struct(**cells_of('d', PART) | cells_of('d', LARGE), g='xxhash64(d, 4)')})"


def sketch(of: str, part: int) -> str:
    """SQL: the cells of placed digests, part by part."""
    zero, add = struct(n="0", k="0L", h="0L"), struct(n="s.n + 1", k="s.k ^ e.k", h="s.h ^ e.h")
    parts = (f"transform(sequence({n * part}, {n * part + part - 1}), c -> aggregate(filter({of}, e -> e.{f} = c), {zero}, (s, e) -> {add}))" for n, f in enumerate(COLUMNS[part]))
    return f"concat({', '.join(parts)})"


def peeled(cells: str, part: int) -> str:
    """SQL: (left, plus, minus, on) after taking out whatever single digests the cells give away.

    A round takes all of them at once; the first one that finds none is the last.
    """
    pure = "filter(st.left, x -> abs(x.n) = 1 and x.h = xxhash64(x.k, 99))"
    keys = f"transform(array_distinct(transform({pure}, x -> {struct(n='x.n', k='x.k')})), p -> {struct(n='p.n', **cells_of('p.k', part))})"
    take = struct(n="s.n - p.n", k="s.k ^ p.k", h="s.h ^ p.h")
    # A cell of a part can only lose digests by their cell in that part.
    parts = (f"transform(slice(st.left, {n * part + 1}, {part}), (x, i) -> aggregate(filter(ps, p -> p.{c} = i + {n * part}), x, (s, p) -> {take}))" for n, c in enumerate(COLUMNS[part]))
    after = struct(left=f"concat({', '.join(parts)})", plus="st.plus + size(filter(ps, p -> p.n > 0))", minus="st.minus + size(filter(ps, p -> p.n < 0))", on="size(ps) > 0")
    stop = struct(left="st.left", plus="st.plus", minus="st.minus", on="false")
    step = f"if(not st.on, st, {let(keys, 'ps', f'if(size(ps) = 0, {stop}, {after})')})"
    return f"aggregate(sequence(1, {3 * part}), {struct(left=cells, plus='0', minus='0', on='true')}, (st, r) -> {step})"


def tried(a: str, b: str, part: int, differ: str, sketches: tuple[str, str] | None = None) -> str:
    """SQL: (ok, plus, minus, differ) of subtracting and peeling two sketches.

    ``differ``: how many digests are known to differ.  Where they are more than the
    cells can give away, nothing is built.  The subtracted cells estimate how many digests
    they hold by their squared counts, as each differing digest is in three cells; with far
    more than they can give away nothing is peeled.
    """
    fewest = f"greatest({differ}, abs(size({a}) - size({b})))"
    ours, theirs = sketches or (sketch(a, part), sketch(b, part))
    subtract = f"zip_with({ours}, {theirs}, (s, t) -> {struct(n='s.n - t.n', k='s.k ^ t.k', h='s.h ^ t.h')})"
    estimate = f"greatest(abs(size({a}) - size({b})), cast(aggregate(cells, 0, (s, x) -> s + x.n * x.n) / 3 as int))"
    result = struct(ok="not exists(d.left, x -> x.n <> 0 or x.k <> 0L)", plus="d.plus", minus="d.minus", differ="holds")
    failed = lambda differ: struct(ok="false", plus="0", minus="0", differ=differ)
    peel = f"if(holds > {4 * part}, {failed('holds')}, {let(peeled('cells', part), 'd', result)})"
    return f"if({fewest} > {2 * part}, {failed(fewest)}, {let(subtract, 'cells', let(estimate, 'holds', peel))})"


def difference(a: str, b: str, first: tuple[str, str]) -> str:
    """SQL: (plus, minus): how many digests only ``a`` and only ``b`` has; ``first``: their
    first sketches.

    ``todo`` holds the sketches still to be tried: their digests on both sides, the
    bits of the hash that chose them, and how many are expected to differ.
    """
    either = f"if(p.differ <= {FEW}, {tried('p.a', 'p.b', PART, 'p.differ')}, {tried('p.a', 'p.b', LARGE, 'p.differ')})"
    results = f"transform(state.todo, p -> {struct(t=either, a='p.a', b='p.b', bits='p.bits')})"
    many = f"r.t.differ > {4 * FEW}"
    child = lambda side: f"filter(r.{side}, e -> (shiftrightunsigned(e.g, r.bits) & if({many}, 15L, 3L)) = j)"
    part = struct(a=child("a"), b=child("b"), bits=f"r.bits + if({many}, 4, 2)", differ=f"cast(r.t.differ / if({many}, 16, 4) as int)")
    more = f"filter(flatten(transform(filter(rs, r -> not r.t.ok), r -> transform(sequence(0, if({many}, 15, 3)), j -> {part}))), p -> size(p.a) + size(p.b) > 0)"
    total = lambda side: f"aggregate(filter(rs, r -> r.t.ok), state.{side}, (s, r) -> s + r.t.{side})"
    step = let(results, "rs", struct(todo=more, plus=total("plus"), minus=total("minus")))
    keys = lambda of: f"transform(p.{of}, e -> e.k)"
    rest = lambda side, of, other: f"state.{side} + aggregate(state.todo, 0, (s, p) -> s + size(array_except({keys(of)}, {keys(other)})))"
    start = struct(todo=f"array({struct(a=a, b=b, bits='0', differ='f.differ')})", plus="0", minus="0")
    larger = f"""aggregate(sequence(1, {LEVELS}), {start}, (state, level) -> if(size(state.todo) = 0, state, {step}),
        state -> {struct(plus=rest('plus', 'a', 'b'), minus=rest('minus', 'b', 'a'))})"""
    return let(tried(a, b, PART, "0", first), "f", f"if(f.ok, {struct(plus='f.plus', minus='f.minus')}, {larger})")


def likeness(a: str, b: str, first: tuple[str, str]) -> str:
    """SQL: common / all digests of two documents."""
    value = f"if(size({a}) + d.minus = 0, 1.0D, (size({a}) - d.plus) / cast(size({a}) + d.minus as double))"
    return let(difference(a, b, first), "d", value)


def fingerprint(first: str) -> str:
    """SQL: the first sketch in hexadecimal: of each cell the count and the digests' XOR."""
    return f"array_join(transform({first}, c -> concat(lower(hex(c.n)), ':', lpad(lower(hex(c.k)), 16, '0'))), '.')"


def cells(rows: DataFrame) -> DataFrame:
    """``rows`` (at, h) with ``cell``: ranges of ids, in order, with about equal numbers of rows.

    An id that fills several ranges by itself - rows without an id, or a repeated one -
    is cut further by the hash of the text.  Its rows with one and the same text become
    one with a count ``n``, added up in each task before the shuffle.
    """
    spark = rows.sparkSession
    ranges = 4 * partitions(spark)
    ids = rows.select("at")
    total, cuts = ids.agg(F.count("*"), F.percentile_approx("at", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()
    cuts = sorted(set(cuts or []))
    cell = F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda c: c < F.col("at"))) if cuts else F.lit(0)
    # At most ``ranges`` ids have this many rows.
    counted = ids.groupBy("at").agg(F.count("*").alias("n")).where(F.col("n") > max(1, total // ranges)).collect()
    often = [(r["at"], r["n"] * ranges // total + 1) for r in counted]
    rows = rows.withColumn("n", F.lit(1).cast("long"))
    if often:
        heavy = F.broadcast(spark.createDataFrame(often, "often long, parts int"))
        told = rows.join(heavy, F.col("at") == F.col("often"), "left").drop("often")
        one = told.where("parts is not null").groupBy("doc_id", "at", "h", "text", "parts").agg(F.sum("n").alias("n"))
        rows = told.where("parts is null").unionByName(one)
        part = F.coalesce(F.floor((F.col("h") / 2.0**64 + 0.5) * F.col("parts")), F.lit(0))
        return rows.withColumn("cell", (cell * (ranges + 2) + F.least(part, F.lit(ranges))).cast("long")).drop("parts")
    return rows.withColumn("cell", cell.cast("long"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, own (its digests), and next_text and next_own: those of the next
    document by descending doc_id, after the last the first.

    Documents are dealt to cells.  The first document of each cell also goes to the cell
    above it, whose last document it follows; of the highest cell, to the lowest.  Only the
    bounds and those first documents' ids and hashes (one a cell) pass through the driver.
    """
    spark = docs.sparkSession
    rows = ids_and_texts(docs).withColumn("at", F.coalesce("doc_id", F.lit(-NULL_ID))).withColumn("h", F.xxhash64("text"))
    rows = cells(rows).withColumn("own", F.expr(digests("text")))
    tops = [(r["cell"], *r["top"]) for r in rows.select("cell", "at", "h").groupBy("cell").agg(F.max(F.struct("at", "h")).alias("top")).orderBy("cell").collect()]
    also = [(at, h, tops[(i + 1) % len(tops)][0]) for i, (_, at, h) in enumerate(tops)]
    guests = F.broadcast(spark.createDataFrame(also, "top_at long, top_h long, to_cell long"))
    here = F.struct("cell", F.lit(False).alias("guest"))
    dealt = (
        rows.join(guests, (F.col("at") == F.col("top_at")) & (F.col("h") == F.col("top_h")), "left")
        .withColumn("c", F.explode(F.when(F.col("to_cell").isNull(), F.array(here)).otherwise(F.array(here, F.struct(F.col("to_cell").alias("cell"), F.lit(True).alias("guest"))))))
        .select("doc_id", "text", "own", "at", "h", "n", F.col("c.cell").alias("cell"), F.col("c.guest").alias("guest"))
    )
    order = Window.partitionBy("cell").orderBy("guest", F.desc("at"), F.desc("h"), "text")
    both = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next_own", F.lead("own").over(order)).where(~F.col("guest"))
    both = both.select("doc_id", "text", "own", "n", F.coalesce("next_text", "text").alias("next_text"), F.coalesce("next_own", "own").alias("next_own"))
    # Of equal rows that were counted together all but the last are followed by their own text.
    copy = F.explode(F.when(F.col("n") > 1, F.sequence(F.lit(1).cast("long"), F.col("n"))).otherwise(F.array(F.col("n"))))
    both = both.withColumn("copy", copy)
    following = lambda ours, theirs: F.when(F.col("copy") < F.col("n"), F.col(ours)).otherwise(F.col(theirs)).alias(theirs)
    return both.select("doc_id", "text", "own", following("text", "next_text"), following("own", "next_own"))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the
    first as many (or all) of the next document.
    """
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)), substring(next_text, 1, cast(n_chars div 3 as int)))"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.expr(items("own")).alias("own"), F.expr(items(digests("edited"))).alias("changed"), F.expr(items("next_own")).alias("following"))
    firsts = {of: sketch(of, PART) for of in ("own", "changed", "following")}
    # Each first sketch is built once, in one struct that the columns read.
    made = struct(
        fingerprint=fingerprint("f.own"),
        edited_fingerprint=fingerprint("f.changed"),
        near_edited=likeness("own", "changed", ("f.own", "f.changed")),
        near_next=likeness("own", "following", ("f.own", "f.following")),
    )
    rows = rows.select("doc_id", "n_chars", "edited_sha256", F.expr(f"explode(array({let(struct(**firsts), 'f', made)}))").alias("made"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "made.fingerprint", "made.edited_fingerprint", "made.near_edited", "made.near_next")
