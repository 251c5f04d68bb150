"""Fill-in-the-middle: texts cut at line ends, their parts moved by a displacement scatter.

A text of n lines is cut twice, after a number of lines that a hash of its id draws, into prefix,
middle and suffix. `psm` writes `<P>`prefix`<S>`suffix`<M>`middle, `spm` writes
`<S>`suffix`<P>`prefix`<M>`middle, `plain` the text itself.

All texts of a slice of an Arrow batch lie in one array of bytes. Line ends are scanned in one go;
every part gets a shift, its place in the output less its place in the input, and a difference array
holds at the start of each part by how much the shift changes there. Its cumulative sum is the
shift of every byte, and one scatter writes all bytes of the slice to their places. To restore a text,
the marks are found in the output, the same shifts follow from them, and one gather reads the
bytes back. Bytes are taken in blocks that carry the running sum on, so a very long text needs no
more than its own bytes and a block.

Cases: a null or empty text is plain and empty. A text that holds a mark is plain, so the marks of
the other forms are the only ones in them. A null id is drawn for as the empty string; repeated rows
come out alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: marks of prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = np.array([PLAIN, PSM, SPM], object)
SLICE = 4 << 20  # bytes of texts that are moved together
BLOCK = 1 << 20  # bytes whose shifts are held at once
MARK = 3  # bytes of a mark


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than texts) and the bytes of a column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return places - places[0], np.empty(0, np.uint8)
    return places - places[0], np.frombuffer(data, np.uint8)[places[0] : places[-1]]


def text_column(places: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(places.astype(np.int32).tobytes())
    return pa.StringArray.from_buffers(len(places) - 1, offsets, pa.py_buffer(data))


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows in order, so many together that their texts take about `size` bytes."""
    places, _ = text_bytes(batch.column(column))
    first = 0
    while first < len(places) - 1:
        last = max(first + 1, int(np.searchsorted(places, places[first] + size, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def marks_at(data: np.ndarray) -> np.ndarray:
    """Where a mark starts."""
    found = np.flatnonzero(data[: max(0, len(data) - 2)] == PREFIX[0])
    letters = np.frombuffer(PREFIX[1:2] + SUFFIX[1:2] + MIDDLE[1:2], np.uint8)
    return found[(data[found + 2] == PREFIX[2]) & np.isin(data[found + 1], letters)]


def rows_with(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of each mark its row, or -1 if it reaches across an end."""
    row = np.searchsorted(places, marks, side="right") - 1
    return np.where(marks + MARK <= places[row + 1], row, -1)


def shifts(starts: np.ndarray, by: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of n bytes, block by block: the block's start and where each of its bytes goes.

    `by` are the shifts of parts that start, in order, at `starts`; a part may be empty.
    """
    change = np.diff(by, prepend=0)
    carried = 0
    for low in range(0, n, BLOCK):
        high = min(n, low + BLOCK)
        inside = slice(*np.searchsorted(starts, [low, high]))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[inside] - low, change[inside])
        difference[0] += carried
        shift = np.cumsum(difference)
        carried = int(shift[-1])
        yield low, shift + np.arange(low, high)


def layout(form: np.ndarray, begin: np.ndarray, p: np.ndarray, m: np.ndarray, s: np.ndarray):
    """Where prefix, middle and suffix, and the three marks, lie in outputs that start at `begin`.

    `p`, `m`, `s` are the lengths of the parts, `form` indexes FORMS.
    """
    moved = [
        # plain, psm, spm
        np.choose(form, [begin, begin + MARK, begin + 2 * MARK + s]),
        np.choose(form, [begin + p, begin + 3 * MARK + p + s, begin + 3 * MARK + p + s]),
        np.choose(form, [begin + p + m, begin + 2 * MARK + p, begin + MARK]),
    ]
    return moved, [moved[0] - MARK, moved[2] - MARK, moved[1] - MARK]


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many code points start before each of the ascending places."""
    found, total, k = np.zeros(len(at), np.int64), 0, 0
    for low in range(0, len(data), BLOCK):
        sums = np.append(0, np.cumsum((data[low : low + BLOCK] & 0xC0) != 0x80))
        last = int(np.searchsorted(at, low + len(sums) - 1, side="right"))
        found[k:last] = total + sums[at[k:last] - low]
        total, k = total + int(sums[-1]), last
    return found


def draws(doc_id: object, salt: int) -> list[int]:
    """Four numbers of 32 bits that only depend on the id."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def scatter(
    places: np.ndarray, data: np.ndarray, drawn: np.ndarray, share: int = 100, spm: int = 50
) -> dict[str, np.ndarray]:
    """Cut, choose forms and move: `drawn` has four numbers per text.

    `share` of 100 texts are moved, `spm` of 100 of those as spm.
    """
    begin, end = places[:-1], places[1:]
    feeds = np.flatnonzero(data == ord("\n"))
    first = np.searchsorted(feeds, begin)
    n_feeds = np.searchsorted(feeds, end) - first
    ends_open = (end > begin) & (data[np.maximum(end - 1, 0)] != ord("\n")) if len(data) else end > begin
    n = n_feeds + ends_open
    drawn_lines = drawn[:, :2] % (n + 1)[:, None]
    cut = []
    for lines in (drawn_lines.min(axis=1), drawn_lines.max(axis=1)):
        behind = np.append(feeds, 0)[np.minimum(first + lines - 1, len(feeds))] + 1
        cut.append(np.where(lines == 0, begin, np.where(lines > n_feeds, end, behind)))
    marked = np.zeros(len(n) + 1, bool)
    marked[rows_with(marks_at(data), places)] = True  # the last is of no row
    plain = (end == begin) | marked[:-1] | (drawn[:, 2] % 100 >= share)
    form = np.where(plain, 0, np.where(drawn[:, 3] % 100 < spm, 2, 1))
    p, m, s = cut[0] - begin, cut[1] - cut[0], end - cut[1]
    out_places = np.append(0, np.cumsum(end - begin + np.where(plain, 0, 3 * MARK)))
    moved, marks = layout(form, out_places[:-1], p, m, s)
    out = np.empty(out_places[-1], np.uint8)
    starts = np.stack([begin, *cut], axis=1)
    for low, to in shifts(starts.ravel(), (np.stack(moved, axis=1) - starts).ravel(), len(data)):
        out[to] = data[low : low + len(to)]
    for mark, at in zip((PREFIX, SUFFIX, MIDDLE), marks, strict=True):
        for i in range(MARK):
            out[at[~plain] + i] = mark[i]
    counted = code_points(data, starts.ravel()).reshape(-1, 3)
    return {
        "n": n, "form": form, "plain": plain, "places": out_places, "out": out,
        "prefix_chars": counted[:, 1] - counted[:, 0], "middle_chars": counted[:, 2] - counted[:, 1],
    }


def gather(places: np.ndarray, data: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and bytes of the texts that outputs of these forms were made of."""
    begin, end = places[:-1], places[1:]
    moved = np.flatnonzero(form > 0)
    marks = marks_at(data)
    rows = rows_with(marks, places)
    marks, rows = marks[np.isin(rows, moved)], rows[np.isin(rows, moved)]
    if not np.array_equal(rows, np.repeat(moved, 3)):
        raise ValueError("an output has not the three marks of its form")
    # in psm the marks come as prefix, suffix, middle; in spm suffix comes first
    _, second, third = marks.reshape(-1, 3).T
    p, m, s = end - begin, np.zeros_like(end), np.zeros_like(end)
    ahead, behind = second - begin[moved] - MARK, third - second - MARK
    is_spm = form[moved] == 2
    p[moved], s[moved] = np.where(is_spm, behind, ahead), np.where(is_spm, ahead, behind)
    m[moved] = end[moved] - third - MARK
    in_places = np.append(0, np.cumsum(p + m + s))
    back, _ = layout(form, begin, p, m, s)
    starts = np.stack([in_places[:-1], in_places[:-1] + p, in_places[:-1] + p + m], axis=1)
    text = np.empty(in_places[-1], np.uint8)
    for low, of in shifts(starts.ravel(), (np.stack(back, axis=1) - starts).ravel(), len(text)):
        text[low : low + len(of)] = data[of]
    return in_places, text


def rearrange(
    docs: DataFrame,
    *,
    salt: int = 7,
    share: int = 100,
    spm: int = 50,
    id_column: str = "doc_id",
    text_name: str = "text",
) -> DataFrame:
    """Columns id, n (lines), form, prefix_chars, middle_chars (null if plain), output."""
    rows = docs.select(F.col(id_column), F.coalesce(F.col(text_name), F.lit("")).alias("text"))
    schema = T.StructType([
        rows.schema[id_column],
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                ids = part.column(0)
                drawn = np.array([draws(one, salt) for one in ids.to_pylist()], np.int64)
                made = scatter(*text_bytes(part.column(1)), drawn.reshape(-1, 4), share, spm)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(made["n"], pa.int64()),
                        pa.array(FORMS[made["form"]], pa.string()),
                        pa.array(made["prefix_chars"], pa.int64(), mask=made["plain"]),
                        pa.array(made["middle_chars"], pa.int64(), mask=made["plain"]),
                        text_column(made["places"], made["out"]),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(move, schema)


def restore(
    moved: DataFrame, *, output_column: str = "output", form_column: str = "form"
) -> DataFrame:
    """All columns but the output, in place of it `restored`: the text, from output and form alone."""
    names = [c for c in moved.columns if c not in (output_column, "restored")]
    rows = moved.select(output_column, *names)
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("restored", T.StringType())])
    form_at = rows.columns.index(form_column)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                form = np.array([(PLAIN, PSM, SPM).index(f) for f in part.column(form_at).to_pylist()])
                found = gather(*text_bytes(part.column(0)), form)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], text_column(*found)], schema.names
                )

    return rows.mapInArrow(read, schema)
