"""Chinese numerals as column expressions (H1, H2, H3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeral characters and what they stand for.
DIGIT_VALUES = {
    "零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4,
    "五": 5, "六": 6, "七": 7, "八": 8, "九": 9,
    "十": 10, "百": 100, "千": 1000,
}
# Character class of a numeral inside an article label.
NUMERAL = "[一二三四五六七八九十百千零两]+"
NUMERAL_ANY = "[一二三四五六七八九十百千零〇两]+"

_DIGITS = "零一二三四五六七八九"


def numeral_to_int(text: Column) -> Column:
    """H1: numeral text to int; a character that is no numeral gives NULL."""
    values = F.create_map(*[F.lit(x) for kv in DIGIT_VALUES.items() for x in kv])
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("digit"))

    def step(acc: Column, char: Column) -> Column:
        value = values[char]
        unit = F.when(acc["digit"] == 0, 1).otherwise(acc["digit"]) * value
        is_unit = value >= 10
        return F.when(
            value.isNotNull(),
            F.struct(
                F.when(is_unit, acc["sum"] + unit).otherwise(acc["sum"]).alias("sum"),
                F.when(is_unit, F.lit(0)).otherwise(value).alias("digit"),
            ),
        )

    trimmed = F.trim(text)
    folded = F.aggregate(
        F.split(trimmed, ""), start, step, lambda acc: acc["sum"] + acc["digit"]
    )
    return F.when(F.length(trimmed) > 0, folded)


def label_to_int(label: Column) -> Column:
    """H1: article number of a label such as 第X条, X、, 12. or 第X条_2."""
    bare = F.regexp_replace(F.trim(label), r"_?\d+$", "")
    inner = F.regexp_extract(bare, "第([零一二三四五六七八九十百千\\d]+)条", 1)
    loose = F.regexp_extract(bare, "^第?([零一二三四五六七八九十百千\\d]+)[、.．)）:：]?$", 1)
    body = F.coalesce(F.nullif(inner, F.lit("")), F.nullif(loose, F.lit("")))
    return F.when(body.rlike(r"^\d+$"), body.try_cast("int")).otherwise(numeral_to_int(body))


def int_to_numeral(number: Column) -> Column:
    """H2: int in 1..9999 to its standard numeral (with the filling 零)."""
    n = number.cast("int")
    ones, tens = n % 10, F.floor(n / 10) % 10
    hundreds, thousands = F.floor(n / 100) % 10, F.floor(n / 1000) % 10

    def digit(d: Column) -> Column:
        return F.substring(F.lit(_DIGITS), d.cast("int") + 1, F.lit(1))

    return F.concat(
        F.when(thousands > 0, F.concat(digit(thousands), F.lit("千"))).otherwise(""),
        F.when(hundreds > 0, F.concat(digit(hundreds), F.lit("百")))
        .when((thousands > 0) & ((tens > 0) | (ones > 0)), "零").otherwise(""),
        F.when((tens == 1) & (n < 20), "十")
        .when(tens > 0, F.concat(digit(tens), F.lit("十")))
        .when((hundreds > 0) & (ones > 0), "零").otherwise(""),
        F.when(ones > 0, digit(ones)).otherwise(""),
    )


def year_numeral_to_int(text: Column) -> Column:
    """H3: a four-digit year written digit by digit."""
    return F.translate(text, "〇○零一二三四五六七八九", "000123456789").try_cast("int")
