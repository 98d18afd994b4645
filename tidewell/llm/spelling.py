"""Spelling variants of frequent words by letter-parity masks (operator 12).

A word's mask holds, for every letter, whether it stands in the word an odd number of times. One
inserted or deleted code point flips one bit, one replaced code point two or none, so of three
bands of the mask at least one stays as it is. Words with an equal band and lengths that differ
by one at most are joined and verified. An edit also leaves either the first or the second half
of the shorter word as it is; that half is part of the join's key, which keeps groups small
where many words have a band in common, and loses nothing. Letters share the mask's thirty bits.

Everything is a column expression: words are counted with partial sums before they are shuffled,
and only the counted vocabulary is joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import heavy_limit, spread_join, staged, unstage

#: Fixed values of the contract: what a word is made of, its least length and count, when a form is one.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_CHARS, LEAST_COUNT, TIMES, DELETE_EVERY = 7, 2, 10, 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The letters of a lower-cased run. Letter i is one of the ten bits of band i % BANDS; where two
#: letters share a bit, an edit still flips two bits at most.
LETTERS = _LOWER + "".join(map(chr, range(0xC0, 0x100)))
BANDS, BITS = 3, 10


def runs(docs: DataFrame, every: int = DELETE_EVERY) -> DataFrame:
    """word of each maximal run of letters, with A-Z lower-cased; where `every` divides the crc32 h of
    `<doc_id>:<run>`, without its code point h % length. Where doc_id is null, nothing is deleted."""
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return found.withColumn("h", h).select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, every: int = DELETE_EVERY, least_chars: int = LEAST_CHARS, least: int = LEAST_COUNT) -> DataFrame:
    """word and n of the distinct words with enough code points and occurrences."""
    long_ = runs(docs, every).where(F.length("word") >= least_chars)
    return long_.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def mask(word: str) -> Column:
    """A word's letter-parity mask: an integer of BANDS bands of BITS bits."""
    place = f"(instr('{LETTERS}', c) - 1)"
    bit = f"cast({place} % {BANDS} * {BITS} + ({place} div {BANDS}) % {BITS} as int)"
    return F.expr(f"aggregate(split({word}, ''), 0, (m, c) -> m ^ if(c <> '', shiftleft(1, {bit}), 0))")


def _band(mask_: Column, i: int | Column) -> Column:
    return F.call_function("shiftright", mask_, i * BITS if isinstance(i, Column) else F.lit(i * BITS)).bitwiseAND(F.lit((1 << BITS) - 1))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every two words that differ by exactly one inserted, deleted or replaced code point, once.

    In class s stand the words of s code points (own) and those of s + 1; pairs of a class have an
    own word. A pair is made by the first band that its masks have in common and by its first half,
    if that is equal, only. Rows are narrow, as each word makes twelve: what they are joined by is
    one hash, and the join's condition looks at everything again.
    """
    size = F.length("word")
    classes = F.explode(F.array(F.struct(size.alias("s"), F.lit(1).alias("own")), F.struct((size - 1).alias("s"), F.lit(0).alias("own"))))
    rows = words.select("word", "n", mask("word").alias("mask"), classes.alias("c")).select("word", "n", "mask", "c.s", "c.own")
    half = F.floor(F.col("s") / 2).cast("int")
    sides = F.array(F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), F.length("word") - F.col("s") + half + 1, F.col("s") - half))
    rows = rows.select("word", "n", "mask", "s", "own", F.posexplode(sides).alias("side", "part"))
    rows = rows.select("word", "n", "mask", "s", "own", "side", "part", F.explode(F.array(*[F.lit(b) for b in range(BANDS)])).alias("band"))
    place = (F.col("band") * 2 + F.col("side")).cast("byte")
    rows = rows.select(F.xxhash64("s", "band", _band(F.col("mask"), F.col("band")), "side", "part").alias("key"), "word", "n", "mask", F.col("own").cast("byte").alias("own"), place.alias("place"))
    x, y = rows.alias("x"), rows.alias("y")
    band, side = F.floor(F.col("x.place") / 2).cast("int"), F.col("x.place") % 2
    own = F.col("x.own") * 2 + F.col("y.own")  # of both sides, so that both sides' rows are the same and shuffled once
    once = (own == 2) | ((own == 3) & (F.col("x.word") < F.col("y.word")))
    equal = lambda b: _band(F.col("x.mask"), b) == _band(F.col("y.mask"), b)
    half = F.floor(F.length("x.word") / 2).cast("int")
    head = F.substring(F.col("x.word"), F.lit(1), half) == F.substring(F.col("y.word"), F.lit(1), half)
    again = ((band > 0) & equal(0)) | ((band > 1) & equal(1)) | ((side == 1) & head)
    fits = (F.col("x.place") == F.col("y.place")) & (F.length("y.word") == F.length("x.word") + 1 - F.col("y.own"))
    flipped = F.bit_count(F.col("x.mask").bitwiseXOR(F.col("y.mask"))) <= 2
    edit = F.levenshtein("x.word", "y.word", 1) == 1
    # Spark takes the twelve rows of a word for one when it guesses their size, and would send them all to the driver
    joined = x.join(y.hint("merge"), [F.col("x.key") == F.col("y.key"), fits & once & equal(band) & flipped & ~again & edit])
    return joined.select(F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"), F.col("y.n").alias("n_b"))


def _roots(forms: DataFrame, most: int, times: int) -> DataFrame:
    """word and root of the words that have a form, a staged table.

    A form has `times` the occurrences of its word at least, so the most frequent word bounds how
    long a chain of forms is; its ends are found by doubling the steps.
    """
    steps = max(1, math.ceil(math.log2(max(2, math.log(max(most, 2), times) + 1))))
    current = staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(steps):
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        asked = current.groupBy("root").count()
        following = spread_join(current, ahead, ["root"], "word", asked, heavy_limit(current.count()), "left").select("word", F.coalesce("beyond", "root").alias("root"))
        following = staged(following, "roots")
        unstage(current)
        current = following
    return current


def variants(docs: DataFrame, every: int = DELETE_EVERY, least_chars: int = LEAST_CHARS, least: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """One row a word: word, form (its near word of largest n, if that is at least `times` its own; of
    equals the smallest in code-point order; else null), root (where following the forms ends; the
    word itself without one), n, n_near (how many near words it has) and form_n (the form's n).

    Words are those of vocabulary(): null and empty texts have none, and a text of any length is
    split as a whole. Rows that repeat a doc_id are all counted, and so are rows without one. An
    empty table gives an empty result. Further columns aren't read.
    """
    words = staged(vocabulary(docs, every, least_chars, least), "words")
    pairs = near_pairs(words)
    side = lambda a, b: F.struct(F.col(a).alias("word"), F.struct((-F.col(f"n_{b}")).alias("n"), F.col(b).alias("w")).alias("near"))
    both = pairs.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("x")).select("x.*")
    best = staged(both.groupBy("word").agg(F.min("near").alias("best"), F.count("*").alias("n_near")), "near-words")
    known = words.join(best.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(-F.col("best.n") >= times * F.col("n"), F.col("best")).alias("best"))
    known = staged(known.select("word", F.col("best.w").alias("form"), "n", "n_near", (-F.col("best.n")).alias("form_n")), "known")
    unstage(words, best)
    roots = _roots(known.where("form is not null"), known.agg(F.max("n")).first()[0] or 0, times)
    return known.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
