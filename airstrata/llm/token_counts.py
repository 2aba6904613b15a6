"""Token counts of whole texts; huge texts in overlapping chunks, joined where they agree."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import texts
from .tokens import encoder

CHUNK = 32_768
OVERLAP = 512


def boundaries(encoding, offset: int, last: int | None) -> dict[int, int]:
    """Text position -> token number, where a pre-token starts; none after ``last``."""
    starts, before = {}, None
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != before and (last is None or start <= last):
            starts[offset + start] = i
        before = word
    return starts


def resynchronised(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Ids of ``text`` from chunks of ``chunk`` characters that overlap.

    Two neighbours are spliced at the first position where both start a
    pre-token. What follows a pre-token start depends on the text after it only,
    so from there on the right chunk's ids are those of the whole text. The left
    chunk's starts count only while what is after them in the chunk is longer
    than every added token plus one character, so that its end cannot have
    changed them. Without a common start the left chunk is encoded again with
    twice the overlap, at last up to the end of the text.
    """
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    margin = max(map(len, added), default=0) + 1
    ids: list[int] = []
    start = 0  # a true start: the text's, or a splice
    while True:
        reach, wider = start + chunk, overlap
        while True:
            end = min(reach + wider, len(text))
            left = tokenizer.encode(text[start:end], add_special_tokens=False)
            if end == len(text):
                return ids + left.ids
            ours = boundaries(left, start, end - start - margin)
            right = tokenizer.encode(text[reach : end + wider], add_special_tokens=False)
            theirs = boundaries(right, reach, None)
            common = min((p for p in ours if p >= reach and p in theirs), default=None)
            if common is not None:
                break
            wider *= 2
        ids += left.ids[: ours[common]]
        start = common


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 512,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (``n_tokens > limit``).

    Nothing is added, cut or padded; a string in a text that spells an added
    token counts as the library counts it. NULL and empty texts have 0 tokens. Repeated
    rows and ids are counted each. Texts of more than ``chunk`` characters are
    encoded chunk by chunk, so the library never holds offsets of more than two
    chunks. One narrow pass; nothing is shuffled.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(tokenizer_path)
        for frame in frames:
            usual = own.encode_many(text for text in frame["text"] if len(text) <= chunk)
            found = [
                len(resynchronised(own.tokenizer, text, chunk)) if len(text) > chunk else len(next(usual))
                for text in frame["text"]
            ]
            yield frame[["doc_id", "n_bytes"]].assign(n_tokens=found)

    rows = texts(docs, id_column, text_column)
    key = rows.schema["doc_id"].dataType.simpleString()
    sized = rows.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = sized.mapInPandas(count, f"doc_id {key}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
