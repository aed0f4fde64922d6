"""Vector expressions for pairs that already share a row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, accumulated in double."""
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def inner_product(a: Column, b: Column) -> Column:
    """Inner product, accumulated in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def similarity_score(distance: Column) -> Column:
    """``1 / (1 + distance)`` for a squared L2 distance: 1 is identical."""
    return F.lit(1.0) / (F.lit(1.0) + distance)


#: Words of the feature hashing: lower-case letters of Western scripts and digits.
WORD = r"[a-z0-9\x{e0}-\x{ff}]+"


def feature_words(text: Column) -> Column:
    """The words of a text that :func:`hashed_words` counts."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def hashed_words(words: Column, dimension: int) -> Column:
    """A vector of signed word counts: the MD5 of a word tells its place (first
    four digits) and its sign (the fifth).

    Whole numbers, so distances are exact; any engine with MD5 gives the same.
    """
    return counted_codes(word_codes(words, dimension), dimension)


#: Characters from here on stand for the codes of words, two for each place.
_FIRST_CODE, _LAST_CODE = 0x100, 0xD7FF


def word_codes(words: Column, dimension: int) -> Column:
    """A text with one character per word, which tells its place and sign."""
    if _FIRST_CODE + 2 * dimension > _LAST_CODE + 1:
        raise ValueError(f"a dimension above {(_LAST_CODE + 1 - _FIRST_CODE) // 2} is not supported")

    def code(word: Column) -> Column:
        digits = F.conv(F.substring(F.md5(word), 1, 5), 16, 10).cast("int")
        # Five digits in one number: the place without the last one, the sign by it.
        return F.transform(F.array(digits), lambda x: F.shiftright(x, 4) % dimension * 2 + F.when(x % 16 < 8, 0).otherwise(1))[0]

    numbers = F.transform(words, lambda word: F.lpad(F.hex(code(word) + _FIRST_CODE), 4, "0"))
    return F.decode(F.unhex(F.array_join(numbers, "")), "UTF-16BE")


def counted_codes(codes: Column, dimension: int) -> Column:
    """The vector of the codes of a text: how often each place comes with plus,
    less how often with minus.  Make ``codes`` a column first; it is read often."""

    def without(code: int) -> Column:
        return F.length(F.replace(codes, F.lit(chr(_FIRST_CODE + code)), F.lit("")))

    counts = [(without(2 * i + 1) - without(2 * i)).cast("float") for i in range(dimension)]
    return F.when(codes.isNotNull(), F.array(*counts))
