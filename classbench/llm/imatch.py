"""I-Match document fingerprints (native).

Document frequencies are counted over all documents for each term's 64-bit hash;
terms in an inverse-document-frequency band make up the lexicon.  As its rarest
term is in a fixed share of the documents, its size is bounded by the texts'
mean number of terms over that share, whatever the corpus.  It is kept as a bit
map of fixed size (128 KB) with two bits a term; other terms pass at a rate that
depends on the lexicon's size alone.  A text's distinct lexicon terms are sorted
and hashed once for each of several randomised subsets of the lexicon: large
ones (three quarters, as the method has it) down to 1/512, of which some hold
none of the terms that an edit of half the text touches.  Likeness is the share
of subsets that hash alike among those that hold a term of either text.

Defined results: a null text is empty; a text without lexicon terms is hashed by
all its terms, and one without terms by its characters, so equal texts always
have equal fingerprints; rows with a null id come after all others; rows that
repeat an id are ordered by their text; an empty table yields no rows; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classbench.llm.common import long_array, range_bucket, range_cuts, read_table

#: Bits of the lexicon's map, 64 to a word, and the shifts of a term's hash that give its bits there.
BUCKET_BITS = 20
PROBES = (0, 20)
#: Band of document frequency over documents: rarer terms are noise, more frequent ones carry nothing.
BAND = (5e-4, 0.2)
#: Randomised subsets: a term belongs to one if its hash, shifted and masked, has (or has not) the value.
SUBSETS = tuple(
    [(2 * i, 3, i % 4, False) for i in range(4)]
    + [(10 + 2 * i, 3, i % 4, True) for i in range(4)]
    + [(20 + 3 * i, 15, 5 * i % 16, True) for i in range(4)]
    + [(32 + 4 * i, 63, 11 * i % 64, True) for i in range(4)])
#: Small subsets: for each quarter of the lexicon, ``GROUP`` disjoint subsets of one part in so many of the quarter.
PARTS = (16, 32, 64, 128)
GROUP = 16
#: Rows of a range of ids that one task sorts.
RANGE_ROWS = 1000


def term_hashes(text: str) -> str:
    """SQL: distinct term hashes of a text; terms are lower-cased runs of letters and digits."""
    words = f"split(lower({text}), r'[^\\p{{L}}\\p{{N}}]+')"
    return f"array_distinct(transform(filter({words}, w -> w != ''), w -> xxhash64(w)))"


def lexicon(texts: DataFrame, column: str, band: tuple[float, float] = BAND) -> list[int]:
    """Bit map of the terms whose document frequency lies in ``band``: 2^20 bits in longs."""
    n = texts.count()
    terms = texts.select(F.explode(F.expr(term_hashes(column))).alias("h")).groupBy("h").agg(F.count("*").alias("df")).where(
        F.col("df").between(max(2, band[0] * n), band[1] * n))
    bit = F.explode(F.array(*[F.shiftright("h", s).bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)) for s in PROBES])).alias("b")
    words = terms.select(bit).groupBy(F.shiftright("b", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(b & 63))")).alias("bits"))
    bits = [0] * (1 << (BUCKET_BITS - 6))
    for r in words.collect():  # at most 2^14 rows of two numbers
        bits[r["word"]] = r["bits"]
    return bits


def signatures(text: str, bits: list[int]) -> Column:
    """One 32-bit hash for each subset of the lexicon, 0 where the subset holds no term of the text."""
    hold = {True: "=", False: "!="}
    hashed = lambda terms: f"transform(array({terms}), y -> if(size(y) = 0, 0, hash(y)))[0]"
    large = ", ".join(hashed(f"filter(t, h -> (shiftright(h, {s}) & {m}L) {hold[inside]} {v}L)") for s, m, v, inside in SUBSETS)
    small = ", ".join(
        f"transform(array(filter(t, h -> (shiftright(h, 40) & 3L) = {q}L)), u -> transform(sequence(0L, {GROUP - 1}L), "
        f"v -> {hashed(f'filter(u, h -> (shiftright(h, 44) & {parts - 1}L) = v)')}))[0]" for q, parts in enumerate(PARTS))
    size = len(SUBSETS) + GROUP * len(PARTS)
    alone = f"array_repeat(if(size(a) = 0, hash({text}), hash(array_sort(a))), {size})"
    lexicon_bits = f"cast(split('{','.join(map(str, bits))}', ',') as array<bigint>)"  # folded to one constant
    mask = (1 << BUCKET_BITS) - 1
    known = " and ".join(f"(shiftright({lexicon_bits}[int(shiftright(shiftright(h, {s}) & {mask}L, 6))], "
                         f"int(shiftright(h, {s}) & 63L)) & 1L) = 1L" for s in PROBES)
    return F.expr(f"transform(array({term_hashes(text)}), a -> transform(array(array_sort(filter(a, h -> {known}))), "
                  f"t -> if(size(t) = 0, {alone}, concat(array({large}), {small})))[0])[0]")


def likeness(a: str, b: str) -> Column:
    """Share of subsets that hash alike among those that are not empty in both."""
    return F.expr(f"coalesce(aggregate(zip_with({a}, {b}, (x, y) -> int(x = y and x != 0L)), 0, (s, x) -> s + x) / "
                  f"nullif(aggregate(zip_with({a}, {b}, (x, y) -> int(x != 0L or y != 0L)), 0, (s, x) -> s + x), 0), 0.0D)")


def fingerprint_text(signs: str) -> Column:
    """The signatures as a string, eight hex digits each."""
    return F.expr(f"array_join(transform({signs}, x -> lpad(lower(hex(x & 4294967295L)), 8, '0')), '')")


def with_next(docs: DataFrame, id_col: str, columns: tuple[str, ...]) -> DataFrame:
    """Each row with ``next``, a struct of ``columns`` of the next lower id; after the last comes the first.

    Rows are dealt by ranges of the id that end with values of the table; the
    row that ends a range also goes, marked, to the range above, and the very
    first to the lowest range, so that every range has its successor at hand and
    the rows are shuffled once.
    """
    cuts = range_cuts(docs, id_col, RANGE_ROWS)
    bucket = range_bucket(F.col(id_col), cuts)
    last = max(len(cuts) - 1, 0)
    ends = F.coalesce(F.get(long_array(cuts or [0]), F.col("_b").cast("int")) == F.col(id_col), F.lit(False))
    above = F.when(F.col("_b") == last, F.lit(0).cast("long")).otherwise(F.col("_b") + 1)
    own = F.struct(F.col("_b").alias("range"), F.lit(False).alias("ghost"))
    dealt = docs.withColumn("_b", bucket).withColumn("_at", F.explode(F.when(
        ends, F.array(own, F.struct(above.alias("range"), F.lit(True).alias("ghost")))).otherwise(F.array(own))))
    order = [F.asc("_ghost"), F.desc_nulls_last(id_col), F.asc("_tie")]
    rows = dealt.withColumn("_range", F.col("_at.range")).withColumn("_ghost", F.col("_at.ghost"))
    rows = rows.withColumn("_tie", F.xxhash64(*columns))
    window = Window.partitionBy("_range").orderBy(*order)
    value = F.struct(*columns)
    after = F.coalesce(F.lead(value).over(window), F.first(value).over(window))
    return rows.withColumn("next", after).where(~F.col("_ghost")).select(*docs.columns, "next")


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, signs, next): texts (null as empty) with their signatures and those of the next document; and the lexicon."""
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bits = lexicon(texts, "text")
    signed = texts.withColumn("signs", signatures("text", bits))
    half = F.floor(F.length("text") / 2).cast("int")
    both = with_next(signed, id_col, ("text", "signs"))
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next.text", half))
    out = both.select(id_col, F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "signs",
                      F.col("next.signs").alias("next_signs"))
    return out.withColumn("edited_signs", signatures("edited", bits))


def op5_imatch(spark, sf_dir) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    pairs = fingerprint_pairs(read_table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint_text("signs").alias("fingerprint"),
        fingerprint_text("edited_signs").alias("edited_fingerprint"), likeness("signs", "edited_signs").alias("near_edited"),
        likeness("signs", "next_signs").alias("near_next"))
