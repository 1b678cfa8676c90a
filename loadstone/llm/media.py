"""Media columns: payloads stored as progressive JPEG, read back as tensors.

A payload is the UTF-8 text, padded with spaces to a positive multiple of 192
bytes.  Its bytes become quantised coefficients, one each: bytes that are common
in UTF-8 prose get small values, by rank, and no byte gets zero, so every byte is
kept exactly by the entropy coder.  Small values and a quantiser of 1 give
samples that vary little, so tensors compress better.  Three blocks of 64 hold
192 bytes; a 4:2:0 MCU has six.  Unused blocks are zero.  The number of unpadded
bytes is the file's comment.  Files of earlier versions, with other values, are
read too.

Reading parses the file, accumulates its scans into coefficient arrays, takes
the payload from these, and inverse-transforms them to full-resolution RGB.
The feature of an image, its size and the mean and spread of each channel, can
be taken while decoding or from stored tensors, with the same result.

Any progressive Huffman JPEG is read, each component with its own table and
sampling; one that is not of :func:`encode_media` has a tensor and a feature, and
no payload.

Defined results: null and empty texts are a payload of 192 spaces with 0
unpadded bytes; equal texts give equal files and features; a text of any length
is one image of up to 65,520 samples a side; a null media value has nulls and no
tensor, bytes that are no such JPEG are an error; repeated rows are each stored;
columns with the names of results are replaced by these.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.llm import jpeg
from loadstone.llm.textnum import buffers, slices

UNIT = 192
STEP = 2 << 20  # payload bytes of images that are coded together


def _values(common: bytes, then: list[int]) -> np.ndarray:
    """Of each byte: 1, -1, 2, -2 and so on for ``common``, ``then`` and all others, in order."""
    rank = np.argsort(list(dict.fromkeys([*common, *then, *range(256)])))
    return np.where(rank % 2 == 0, rank // 2 + 1, -(rank // 2) - 1).astype(np.int32)


#: Common bytes of prose in UTF-8, then others that are printed, are within or begin a character.
COMMON = b" enthairosd\xc3ulc.gb,fwymp\xa9vkzqxj\n\xb3\xa8\xb1\xbc\xa7\xa4\xb6\xaa\x9f\xad\xa0-'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
#: Values of bytes by the name that a file's comment gives its unpadded bytes; ``bytes`` is of files of earlier versions.
VALUES = {b"utf8": _values(COMMON, [*range(32, 127), *range(128, 192), *range(194, 245)]), b"bytes": _values(b" etaonihsrdlucmfywgpbvkxqjz.,", [])}
VALUE = VALUES[b"utf8"]
_BYTES = np.zeros((len(VALUES), 258), dtype=np.uint8)  # byte of each value + 128
for _row, _of in zip(_BYTES, VALUES.values(), strict=True):
    _row[_of + 128] = np.arange(256)
_COMMENT = re.compile(rb"(%s)=(\d+)" % b"|".join(VALUES))


def payloads(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, sizes): padded payloads of texts, one after the other."""
    sizes = np.diff(offsets)
    full = np.maximum(-(-sizes // UNIT), 1) * UNIT
    out = np.full(int(full.sum()), 32, dtype=np.uint8)
    shift = (np.cumsum(full) - full) - offsets[:-1]
    out[np.arange(len(data)) + np.repeat(shift, sizes)] = data
    return out, full


def to_files(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """A JPEG file for each text."""
    payload, full = payloads(data, offsets)
    blocks = full // 64
    cols, rows = jpeg.grid(-(-blocks // 6))
    counts = cols * rows
    coefs = np.zeros((int(counts.sum()) * 6, 64), dtype=np.int32)
    base = 6 * (np.cumsum(counts) - counts)
    at = np.arange(len(payload) // 64) + np.repeat(base - (np.cumsum(blocks) - blocks), blocks)
    coefs[at] = VALUE[payload].reshape(-1, 64)
    return jpeg.encode(coefs.reshape(-1, 6, 64), counts, [b"utf8=%d" % n for n in np.diff(offsets).tolist()])


def comment_of(image: jpeg.Image) -> tuple[int, int] | None:
    """(place of its values in VALUES, unpadded bytes) by a comment of :func:`to_files`."""
    found = next(filter(None, map(_COMMENT.fullmatch, image.comments)), None)
    return found and (list(VALUES).index(found[1]), int(found[2]))


def is_ours(image: jpeg.Image) -> bool:
    """Whether a file is of :func:`to_files`: its comment and its 4:2:0 MCUs."""
    layout = [(c.h, c.v) for c in image.components] == [(2, 2), (1, 1), (1, 1)]
    return layout and image.width % 16 == image.height % 16 == 0 and comment_of(image) is not None


def from_images(images: list[jpeg.Image], coefs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], list[int]]:
    """(MCUs of each, coefficients by MCU, payloads, unpadded bytes) of our own files."""
    kinds, lengths = (list(x) for x in zip(*map(comment_of, images), strict=True))
    cols, rows = (np.array([getattr(x, f) for x in images], dtype=np.int64) for f in ("mcu_cols", "mcu_rows"))
    counts = cols * rows
    image, chroma, luma = jpeg.raster(cols, rows)
    first = (np.cumsum(counts) - counts)[image]
    y, cb, cr = (np.array([x.components[k].base for x in images], dtype=np.int64)[image] for k in range(3))
    order = np.stack([*(y + at - 4 * first for at in luma), cb + chroma - first, cr + chroma - first], axis=1)
    blocks = coefs[order]
    raw = _BYTES[np.array(kinds)[image][:, None, None], blocks + 128].tobytes()
    found = []
    for n, start, count in zip(lengths, np.cumsum(counts) - counts, counts, strict=True):
        size = max(-(-n // UNIT), 1) * UNIT
        if size > 384 * count:
            raise ValueError("the image is smaller than its payload")
        found.append(raw[384 * start : 384 * start + size])
    return counts, blocks, found, lengths


def samples_of(images: list[jpeg.Image], counts: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """RGB samples by MCU of our own files, by each component's table."""
    tables = np.stack([np.stack([x.quants[c.quant] for c in x.components]) for x in images])[:, [0, 0, 0, 0, 1, 2]]
    return jpeg.mcu_rgb(blocks, tables[0] if (tables == tables[0]).all() else np.repeat(tables, counts, axis=0))


def encode_media(rows: DataFrame, text: str = "text", to: str = "media") -> DataFrame:
    """All columns of rows but ``text``, and the stored form as binary column ``to``."""
    keep = [c for c in rows.columns if c not in (text, to)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(len(keep)))
            for a, b in slices(offsets, STEP):
                for first in range(a, b, 4096):
                    last = min(b, first + 4096)
                    files = to_files(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                    yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(first, last - first) for i in range(len(keep))), pa.array(files, pa.binary())], names=[*keep, to])

    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField(to, T.BinaryType())])
    return rows.select(*keep, text).mapInArrow(run, schema)


DECODED = "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def _feature(height: int, width: int, sums: np.ndarray, squares: np.ndarray) -> str:
    mean = sums / (height * width)
    spread = np.sqrt(np.maximum(squares / (height * width) - mean**2, 0))
    return f"{height}x{width}x3;" + ",".join(f"{x:.3f}" for x in [*mean, *spread])


def decode_media(rows: DataFrame, media: str = "media", tensor: bool = True, feature: bool = True) -> DataFrame:
    """All columns of rows but ``media``, then :data:`DECODED` (without
    ``feature`` if not wanted) and, with ``tensor``, struct ``tensor`` (height,
    width, channels, data): RGB samples."""
    decoded = T._parse_datatype_string(DECODED if feature else DECODED.removesuffix(", feature string"))
    kind = T._parse_datatype_string("tensor struct<height: int, width: int, channels: int, data: binary>")
    added = [*decoded.fields, *(kind.fields if tensor else [])]
    keep = [c for c in rows.columns if c != media and c not in {f.name for f in added}]
    arrow = {"tensor": pa.struct([("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("data", pa.binary())])}

    def decoded_rows(files: list[bytes]) -> Iterator[dict]:
        images, coefs = jpeg.decode(files)
        ours = [k for k, image in enumerate(images) if is_ours(image)]
        mine: dict[int, tuple] = {}
        if ours:
            counts, blocks, found, lengths = from_images([images[k] for k in ours], coefs)
            samples = samples_of([images[k] for k in ours], counts, blocks)
            ends = np.cumsum(counts)
            mine = {k: (found[i], lengths[i], samples[ends[i] - counts[i] : ends[i]]) for i, k in enumerate(ours)}
        for k, (image, raw) in enumerate(zip(images, files, strict=True)):
            row = {"media_bytes": len(raw), "media_sha256": hashlib.sha256(raw).hexdigest()}
            if k in mine:
                payload, n, own = mine[k]
                row |= {"n_bytes": n, "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-16:])}
            else:
                own = jpeg.rgb(image, coefs)
            if feature:
                flat = own.reshape(-1, 3)
                row["feature"] = _feature(image.height, image.width, flat.sum(axis=0, dtype=np.int64), np.einsum("pc,pc->c", flat, flat, dtype=np.int64))
            if tensor:
                if k in mine:
                    own = own.reshape(image.mcu_rows, image.mcu_cols, 16, 16, 3).swapaxes(1, 2)
                row["tensor"] = {"height": image.height, "width": image.width, "channels": 3, "data": own.tobytes()}
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(keep))
            sizes = np.array([len(x.as_py() or b"") if x.is_valid else 0 for x in column])
            for first, last in slices(np.concatenate([[0], np.cumsum(sizes)]), STEP // 2):
                files = column.slice(first, last - first).to_pylist()
                found = decoded_rows([f for f in files if f is not None])
                out = [{} if f is None else next(found) for f in files]
                arrays = [pa.array([r.get(f.name) for r in out], arrow.get(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64())) for f in added]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(first, last - first) for i in range(len(keep))), *arrays], names=[*keep, *(f.name for f in added)])

    schema = T.StructType([*(rows.schema[c] for c in keep), *added])
    return rows.select(*keep, F.col(media)).mapInArrow(run, schema)


def tensor_features(rows: DataFrame, tensor: str = "tensor") -> DataFrame:
    """All columns of rows but ``tensor``, and ``feature`` of the samples in it."""
    keep = [c for c in rows.columns if c not in (tensor, "feature")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            height, width, _, data = batch.column(len(keep)).flatten()
            sizes = (height.fill_null(0).to_numpy().astype(np.int64)) * width.fill_null(0).to_numpy()
            features: list[str | None] = []
            for a, b in slices(np.concatenate([[0], np.cumsum(3 * sizes)]), STEP):
                for i in range(a, b):
                    if not sizes[i]:  # no tensor
                        features.append(None)
                        continue
                    flat = np.frombuffer(data[i].as_buffer(), dtype=np.uint8).reshape(-1, 3)
                    features.append(_feature(height[i].as_py(), width[i].as_py(), flat.sum(axis=0, dtype=np.int64), np.einsum("pc,pc->c", flat, flat, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(features, pa.string())], names=[*keep, "feature"])

    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("feature", T.StringType())])
    return rows.select(*keep, tensor).mapInArrow(run, schema)
