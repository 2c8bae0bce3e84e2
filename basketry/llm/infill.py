"""Fill-in-middle: texts cut into prefix, middle and suffix and put in another order.

Cuts are made in bytes. A text's exception index holds only its multibyte characters: their byte and code-point
positions and the bytes they have beyond one, summed up. A cut is converted between code points and bytes by one
binary search in it; spans between exceptions are plain arithmetic, and an ASCII text has an empty index.

Cuts fall between tokens (`[white space]*word` or trailing white space) or between code points (`unit`). All
draws come from the SHA-256 of the seed and the row's key, so they are the same on every run and in any order.
A null text counts as empty and a null key as the empty string; an empty text, or one that holds a marker, stays
plain. Very long texts are cut whole, output leaves a task in bounded slices. Repeated rows with equal keys are
cut alike, tables without rows give none, and other columns are kept: a clashing name of ours gets underscores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from basketry.llm.common import free_name, read_table, text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM_RATE = 42, 50, 80
SLICE_BYTES = 32 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Exceptions:
    """Positions of a text's multibyte characters and the bytes they have in excess of one."""

    def __init__(self, text: np.ndarray):
        self.at = np.flatnonzero(text >= 0xC0)  # lead bytes
        lead = text[self.at]
        self.excess = np.concatenate(([0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)))
        self.place = self.at - self.excess[:-1]  # the same positions in code points
        self.chars = len(text) - int(self.excess[-1])

    def to_byte(self, char: int) -> int:
        return int(char + self.excess[np.searchsorted(self.place, char)])

    def to_char(self, byte: int) -> int:
        return int(byte - self.excess[np.searchsorted(self.at, byte)])


def token_ends(text: np.ndarray) -> np.ndarray:
    """Byte positions where tokens end."""
    if not len(text):
        return np.empty(0, np.int64)
    blank = _BLANK[text]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(text))


def draws(seed: int, key) -> tuple[int, ...]:
    """Four 32-bit numbers of a row."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def cut(text: bytes, h: tuple[int, ...], unit: str, rate: int, spm_rate: int) -> tuple:
    """(units, form, prefix characters, middle characters, output) of a text."""
    codes = np.frombuffer(text, np.uint8)
    index = ends = None
    if unit == "char":
        index = Exceptions(codes)
        n = index.chars
    else:
        ends = token_ends(codes)
        n = len(ends)
    if not text or h[2] % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    index = index or Exceptions(codes)
    if unit == "char":
        i, j = index.to_byte(first), index.to_byte(last)
    else:
        i, j = (int(ends[k - 1]) if k else 0 for k in (first, last))
    before, middle, after = text[:i], text[i:j], text[j:]
    start = index.to_char(i)
    if h[3] % 100 < spm_rate:
        return n, "spm", start, index.to_char(j) - start, b"".join((SUFFIX, after, PREFIX, before, MIDDLE, middle))
    return n, "psm", start, index.to_char(j) - start, b"".join((PREFIX, before, SUFFIX, after, MIDDLE, middle))


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "token", seed: int = SEED,
    rate: int = RATE, spm_rate: int = SPM_RATE,
) -> tuple[DataFrame, dict[str, str]]:
    """The rows with n, form, prefix_chars, middle_chars and output, and the names these columns got.

    rate per cent of the texts are cut, spm_rate per cent of those put the suffix first.
    """
    if unit not in ("token", "char"):
        raise ValueError("unit is token or char")
    kinds = {
        "n": LongType(), "form": StringType(), "prefix_chars": LongType(), "middle_chars": LongType(),
        "output": StringType(),
    }
    names, taken = {}, docs
    for ours, kind in kinds.items():
        names[ours] = free_name(taken, ours)
        taken = taken.withColumn(names[ours], F.lit(None).cast(kind))
    schema = StructType([*docs.schema.fields, *(StructField(names[k], kind) for k, kind in kinds.items())])
    key_at, text_at = docs.columns.index(key), docs.columns.index(text)
    arrow = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def sliced(batch: pa.RecordBatch, start: int, rows: list[tuple]) -> pa.RecordBatch:
        made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)]
        made[-1] = made[-1].cast(pa.string())
        return pa.RecordBatch.from_arrays([*batch.slice(start, len(rows)).columns, *made], schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, start, held = [], 0, 0
            keys = batch.column(key_at).to_pylist()
            for at, found in enumerate(text_bytes(batch, batch.schema.names[text_at])):
                rows.append(cut(found or b"", draws(seed, keys[at]), unit, rate, spm_rate))
                held += len(rows[-1][-1])
                if held >= SLICE_BYTES:
                    yield sliced(batch, start, rows)
                    rows, start, held = [], at + 1, 0
            if rows:
                yield sliced(batch, start, rows)

    return docs.mapInArrow(run, schema), names


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: its parts in their first order."""
    parts = F.split(output, "<[PSM]>", -1)
    whole = F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
    return F.when(form == "plain", output).otherwise(whole.when(form == "spm", F.concat(parts[2], parts[3], parts[1])))


def op11_infill(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    made, _ = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


_TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
OP11_SQL = f"""
with draws as (
    select doc_id, coalesce(text, '') as body,
        regexp_extract_all(coalesce(text, ''), '{_TOKEN}') as tokens,
        sha256('42:' || coalesce(cast(doc_id as varchar), '')) as digest
    from documents
), numbers as (
    select doc_id, body, tokens, len(tokens) as n,
        cast('0x' || substr(digest, 1, 8) as bigint) as h1, cast('0x' || substr(digest, 9, 8) as bigint) as h2,
        cast('0x' || substr(digest, 17, 8) as bigint) as h3, cast('0x' || substr(digest, 25, 8) as bigint) as h4
    from draws
), cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as i, greatest(h1 % (n + 1), h2 % (n + 1)) as j,
        case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') or h3 % 100 >= 50
            then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select *, coalesce(array_to_string(tokens[1:i], ''), '') as before,
        coalesce(array_to_string(tokens[i + 1:j], ''), '') as middle,
        coalesce(array_to_string(tokens[j + 1:], ''), '') as after
    from cuts
)
select doc_id, n, form,
    case when form <> 'plain' then length(before) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then body when 'psm' then '<P>' || before || '<S>' || after || '<M>' || middle
        else '<S>' || after || '<P>' || before || '<M>' || middle end) as output_sha256,
    sha256(body) as restored_sha256
from parts
"""

QUERIES = {"op11_infill": op11_infill}
SQL: dict[str, str] = {"op11_infill": OP11_SQL}
