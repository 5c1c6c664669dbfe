"""Fill-in-the-middle: texts cut at two places and put together in another order.

A text of n code points is cut into prefix, middle and suffix at two places that
a hash of its id gives, and becomes `<P>`prefix`<S>`suffix`<M>`middle (form psm)
or `<S>`suffix`<P>`prefix`<M>`middle (spm); some texts stay as they are (plain).

The cutting is a pyarrow.compute pipeline over slices of a batch: texts become
lists of units, the lists are flattened with the indices of their parents,
ordinals say which role a unit has, units are filtered by role, lists are
rebuilt and joined. A slice holds at most PART bytes; a longer text passes
through in parts, whose pieces are joined at the end.

Null texts count as empty. Empty texts and texts that hold a sentinel are plain.
Rows equal in id and text give equal rows; a null id is hashed as no digits at
all. Rows are never dropped or moved, and further columns stay as they are.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmetrics.llm.common import SLICE, map_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 1
#: Of a hundred texts so many are cut, and of a hundred that are cut so many are spm.
CUT_SHARE = 90
SPM_SHARE = 20
#: Bytes of text in the pipeline at once.
PART = 1 << 22


def part_offsets(data: np.ndarray, offsets: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of parts of at most `limit` bytes, and each part's row.

    `offsets` bound the rows' texts in `data`; parts end between code points, so
    that they hold four bytes at least.
    """
    limit = max(limit, 4)
    edges, rows = [int(offsets[0])], []
    for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while end - start > limit:
            cut = start + limit
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            edges.append(cut)
            rows.append(row)
            start = cut
        edges.append(end)
        rows.append(row)
    return np.array(edges, dtype=np.int64), np.array(rows, dtype=np.int64)


def unit_lists(data: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """The code points of each text, as lists of one-character texts."""
    own = data[offsets[0] : offsets[-1]]
    starts = np.flatnonzero((own & 0xC0) != 0x80)
    edges = np.append(starts, len(own)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(own)))
    bounds = np.searchsorted(starts, offsets - offsets[0]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), units)


def joined_role(flat: pa.Array, parents: pa.Array, mask: pa.Array, lists: int) -> pa.Array:
    """The units under the mask, joined again by the list they came from."""
    sizes = np.bincount(pc.filter(parents, mask).to_numpy(), minlength=lists)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), pc.filter(flat, mask)), "")


def _three(data: np.ndarray, edges: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, done: int) -> tuple[list[pa.Array], int]:
    """Prefix, middle and suffix of each part, and how many units its row has had after the last.

    `done` units of the first part's row came before.
    """
    lists = unit_lists(data, edges)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    sizes = pc.list_value_length(lists).to_numpy()
    before = np.cumsum(sizes) - sizes
    # What the flat number of a row's first unit is; the first row began `done` units earlier.
    start = before[np.searchsorted(rows, rows)] - np.where(rows == rows[0], done, 0)
    ordinals = pc.subtract(pa.array(np.arange(len(flat))), pc.take(pa.array(start), parents))
    prefix = pc.less(ordinals, pc.take(pa.array(low[rows]), parents))
    suffix = pc.greater_equal(ordinals, pc.take(pa.array(high[rows]), parents))
    middle = pc.invert(pc.or_(prefix, suffix))
    past = int(before[-1] + sizes[-1] - start[-1])
    return [joined_role(flat, parents, m, len(lists)) for m in (prefix, middle, suffix)], past


def pieces(texts: pa.Array, low: np.ndarray, high: np.ndarray, limit: int = PART) -> list[pa.Array]:
    """Prefix, middle and suffix of each text: the units before `low`, before `high` and from there on."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1 + texts.offset)[texts.offset :]
    source = texts.buffers()[2]
    data = np.frombuffer(source, dtype=np.uint8) if source is not None and source.size else np.zeros(0, dtype=np.uint8)
    edges, rows = part_offsets(data, offsets.astype(np.int64), limit)
    found: list[list[pa.Array]] = [[], [], []]
    at, done = 0, 0
    while at < len(rows):
        past = max(at + 1, int(np.searchsorted(edges, edges[at] + limit, side="right")) - 1)
        own, units = _three(data, edges[at : past + 1], rows[at:past], low, high, done)
        for have, new in zip(found, own, strict=True):
            have.append(new)
        done = units if past < len(rows) and rows[past] == rows[past - 1] else 0
        at = past
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32)
    return [pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), pa.concat_arrays(f)), "") for f in found]


def assembled(texts: pa.Array, low: np.ndarray, high: np.ndarray, form: pa.Array, limit: int = PART) -> pa.Array:
    """The output of each text by its form."""
    prefix, middle, suffix = pieces(texts, low, high, limit)
    marked = [pc.binary_join_element_wise(mark, piece, "") for mark, piece in ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle))]
    psm = pc.binary_join_element_wise(*marked, "")
    spm = pc.binary_join_element_wise(marked[1], marked[0], marked[2], "")
    return pc.if_else(pc.equal(form, PLAIN), texts, pc.if_else(pc.equal(form, SPM), spm, psm))


def _draws(doc_id: str, seed: int) -> list[Column]:
    """The first four 8-digit groups of the id's digest, as numbers."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    into: str = "fim",
    seed: int = SEED,
    cut_share: int = CUT_SHARE,
    spm_share: int = SPM_SHARE,
) -> DataFrame:
    """`keep` and a struct `into`: n (code points), form, prefix_chars, middle_chars (null if
    plain) and output."""
    h1, h2, h3, h4 = _draws(f"`{doc_id}`", seed)
    own = docs.select(text_or_empty(f"`{text}`").alias("t"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    n = F.char_length("t").cast("long")
    first, second = F.col("h1") % (n + 1), F.col("h2") % (n + 1)
    marks = [F.contains("t", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = (n == 0) | marks[0] | marks[1] | marks[2] | (F.col("h3") % 100 >= cut_share)
    form = F.when(plain, PLAIN).when(F.col("h4") % 100 < spm_share, SPM).otherwise(PSM)
    planned = own.select("t", F.least(first, second).alias("low"), F.greatest(first, second).alias("high"), form.alias("form"), n.alias("n"), "kept")
    schema = T.StructType([T.StructField("output", T.StringType()), *planned.schema.fields[1:]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                low, high = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                made = assembled(part.column(0).cast(pa.string()), low, high, part.column(3))
                yield pa.RecordBatch.from_arrays([made, *part.columns[1:]], names=schema.names)

    whole = map_batches(planned, cut, schema)
    split = F.col("form") != PLAIN
    made = F.struct(
        "n",
        "form",
        F.when(split, F.col("low")).alias("prefix_chars"),
        F.when(split, F.col("high") - F.col("low")).alias("middle_chars"),
        "output",
    )
    return whole.select(*[F.col("kept")[c].alias(c) for c in keep], made.alias(into))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""
    parts = F.split(output.substr(F.lit(4), F.char_length(output)), "<[PSM]>", 3)
    psm = F.concat(parts[0], parts[2], parts[1])
    spm = F.concat(parts[1], parts[2], parts[0])
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
