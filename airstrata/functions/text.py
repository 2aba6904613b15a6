"""Text, JSON and byte decoding."""

from pyspark.sql import Column, functions as F

NON_WORD = r"[^\p{L}\p{N}]+"  # words are maximal runs of letters and digits


def json_number_map(column: Column) -> Column:
    """JSON object text with numeric keys to ``map<double,double>``; NULL if malformed.

    Keys that are no numbers are left out; of keys that are the same number
    (``1`` and ``1.0``) the last counts.
    """
    pairs = F.transform(
        F.map_entries(F.from_json(column, "map<string,double>")),
        lambda e: F.struct(e.key.try_cast("double").alias("key"), e.value.alias("value")),
    )
    numeric = F.filter(pairs, lambda e: e.key.isNotNull())

    def last_of_each(numeric: Column) -> Column:
        keys = F.transform(numeric, lambda e: e.key)
        # From the end, so that the first place of a key is that of its last value.
        both = F.struct(
            F.reverse(numeric).alias("pairs"), F.reverse(keys).alias("keys"), F.array_distinct(keys).alias("once")
        )

        def last(b: Column) -> Column:
            return F.transform(
                b.once, lambda k: F.element_at(b.pairs, F.array_position(b.keys, k).cast("int"))
            )

        return _bound(both, last)

    return F.map_from_entries(_bound(numeric, last_of_each))


def _bound(column: Column, use) -> Column:
    """``use(column)`` with the column evaluated once."""
    return F.get(F.transform(F.array(column), use), F.lit(0))


def utf8_text(column: Column) -> Column:
    """Bytes to text."""
    return F.decode(column, "UTF-8")


def squeeze_whitespace(column: Column, wanted: Column | None = None) -> Column:
    """Runs of blanks, tabs and line ends to one blank, ends trimmed, where ``wanted``."""
    squeezed = F.trim(F.regexp_replace(column, r"[ \t\r\n]+", " "))
    return squeezed if wanted is None else F.when(wanted, squeezed).otherwise(column)
