"""Progressive JPEG in numpy, many images at a time.

Scans are decoded into coefficient arrays: first scans of a spectral band set
coefficients, refinement scans add one bit.  All restart segments of all images
of a batch are decoded in step, one symbol of each per numpy pass, so the cost
of a pass is shared by thousands of streams.  Coefficients are then
dequantised, inverse-transformed by one matrix product, chroma is replicated to
full resolution and converted to RGB.

The encoder writes coefficient arrays, 4:2:0, as: DC with its last bit left
out, AC band 1-57, band 58-63 with its last bit left out, then the refinement
scans of both.
"""

from __future__ import annotations

import bisect
import struct
from dataclasses import dataclass, field

import numpy as np

RESTART = 16  # MCUs (blocks, in scans of one component) between restart markers
BANDS = ((1, 57, 0), (58, 63, 1))
QUANT = 1
_U = np.uint64


def _zigzag() -> np.ndarray:
    """Natural place of each coefficient in zigzag order."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = _zigzag()


def _inverse_transform() -> np.ndarray:
    """(64, 64): coefficients in zigzag order to samples of a block."""
    k = np.arange(8)
    basis = np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16) * np.where(k == 0, np.sqrt(0.125), 0.5)[:, None]
    return np.einsum("ux,vy->uvxy", basis, basis).reshape(64, 64)[ZIGZAG].astype(np.float32)


BITS = 14
#: In whole numbers, times 2^BITS: sums are exact in any order, so samples do not depend on what is decoded together.
IDCT = np.rint(_inverse_transform() * 2.0**BITS)
_MOST = 2**24 // int(np.abs(IDCT).sum(axis=0).max())  # up to such coefficients, sums are exact as 32-bit floats


# --- Huffman tables -------------------------------------------------------


def table_of(lengths: dict[int, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(DHT counts and symbols, code by symbol, length by symbol) of canonical codes."""
    symbols = sorted(lengths, key=lambda s: (lengths[s], s))
    counts = [sum(1 for s in symbols if lengths[s] == n) for n in range(1, 17)]
    codes, sizes, code, last = np.zeros(256, np.int64), np.zeros(256, np.int64), 0, 0
    for s in symbols:
        code <<= lengths[s] - last
        codes[s], sizes[s], last = code, lengths[s], lengths[s]
        code += 1
        if code >= 1 << last:
            raise ValueError("the code lengths leave no room")
    return bytes(counts) + bytes(symbols), codes, sizes


DC_TABLE = table_of(dict.fromkeys(range(12), 4))
AC_TABLE = table_of({1: 3, 2: 3, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 0x00: 4, 0xF0: 9} | {16 * r + s: 9 for r in range(16) for s in range(1, 11) if r or s > 8})
# enough for blocks without any zero, or of nothing but zeros, of 8-bit values
SHORT_TABLE = table_of({1: 2, 2: 2, 3: 2, 4: 3, 5: 4, 6: 5, 7: 6, 8: 7, 0x00: 8})
SHORT_LOW = table_of({16 * r + s: 6 for r in range(6) for s in range(1, 8)} | {0x00: 2})
LOW_TABLE = table_of({16 * r + s: 7 for r in range(6) for s in range(1, 11)} | {0x00: 2, 0xF0: 7})
FINE_TABLE = table_of({0x00: 2, 0x01: 1} | {16 * r + 1: 5 for r in range(1, 6)} | {0xF0: 6})


def lookup(spec: bytes) -> np.ndarray:
    """16 bits to ``length << 8 | symbol``; 0 where no code begins so."""
    out, code, at = np.zeros(1 << 16, np.int32), 0, 16
    for n in range(1, 17):
        for _ in range(spec[n - 1]):
            out[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | spec[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


# --- encoder --------------------------------------------------------------


def _category(values: np.ndarray) -> np.ndarray:
    """Bits of the magnitude."""
    return np.frexp(np.abs(values).astype(np.float64))[1]


def _extra(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(values < 0, values + (1 << size) - 1, values)


def _pack(codes: np.ndarray, lengths: np.ndarray, segment: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each segment): codes in order, segments byte-aligned, padded with ones."""
    bits = np.bincount(segment, weights=lengths, minlength=segments).astype(np.int64)
    sizes = (bits + 7) // 8
    starts = np.concatenate([[0], np.cumsum(sizes)])
    before = np.cumsum(lengths) - lengths
    first = np.concatenate([[0], np.cumsum(bits)])[:-1]
    at = before - first[segment] + 8 * starts[segment]
    pad = (8 * sizes - bits).astype(np.int64)
    at = np.append(at, 8 * starts[:-1] + bits)
    codes, lengths = np.append(codes, (1 << pad) - 1), np.append(lengths, pad)
    words = np.zeros(int(starts[-1]) // 8 + 2, dtype=_U)
    word, shift = at >> 6, 64 - (at & 63) - lengths
    codes = codes.astype(_U)
    whole = shift >= 0
    high = np.where(whole, codes << np.maximum(shift, 0).astype(_U), codes >> np.maximum(-shift, 0).astype(_U))
    main, padding = slice(0, len(at) - segments), slice(len(at) - segments, None)
    for part in (main, padding):  # inside each, words ascend
        w = word[part]
        if len(w):
            cut = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            words[w[cut]] += np.add.reduceat(high[part], cut)
    over = np.flatnonzero(~whole)
    np.add.at(words, word[over] + 1, codes[over] << (64 + shift[over]).astype(_U))
    return words.astype(">u8").view(np.uint8)[: starts[-1]], starts


def _stuffed(data: np.ndarray, starts: np.ndarray, restart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with FF00 for FF, and restart markers before segments where restart >= 0."""
    extra = np.zeros(len(data) + 1, dtype=np.int64)
    full = np.flatnonzero(data == 255)
    extra[full + 1] += 1
    marked = np.flatnonzero(restart >= 0)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(lead, starts[:-1][marked], 2)
    shift = np.cumsum(extra + lead)
    out = np.zeros(len(data) + int(shift[-1]) if len(data) else 0, dtype=np.uint8)
    place = np.arange(len(data)) + shift[:-1]
    out[place] = data
    at = place[starts[:-1][marked]]
    out[at - 2], out[at - 1] = 255, 0xD0 + restart[marked] % 8
    begins = np.append(place, len(out))[np.minimum(starts, len(data))]
    begins[:-1][marked] -= 2
    begins[-1] = len(out)
    return out, begins


@dataclass
class _Scan:
    """One scan of all images: items (code, length) in order with their segment."""

    codes: np.ndarray
    lengths: np.ndarray
    segment: np.ndarray
    per_image: np.ndarray  # segments of each image
    head: bytes


def _with_bits(symbols: np.ndarray, values: np.ndarray, size: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    return table[1][symbols] << size | _extra(values, size), table[2][symbols] + size


def _dc_first(dc: np.ndarray, order: np.ndarray, comp: np.ndarray, segment: np.ndarray):
    """Differences to the block of the same component before it in the segment."""
    v = dc[order] >> 1
    diff = v.copy()
    for c in range(3):
        at = np.flatnonzero(comp == c)
        if len(at):
            same = segment[at[1:]] == segment[at[:-1]]
            diff[at[1:]] -= np.where(same, v[at[:-1]], 0)
    size = _category(diff)
    return _with_bits(size, diff, size, DC_TABLE)


def _ac_first(coefs: np.ndarray, low: int, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, lengths, block) of a band (blocks, width) with ``low`` bits left out."""
    n, width = coefs.shape
    v = np.sign(coefs) * (np.abs(coefs) >> low)
    flat = np.flatnonzero(v)
    block, k = flat // width, flat % width
    before = np.concatenate([[-1], flat[:-1]])
    run = np.where(before // width == block, flat - before - 1, k)
    value = v.reshape(-1)[flat]
    size = _category(value)
    codes, lengths = _with_bits((run % 16) * 16 + size, value, size, table)
    place = flat * 4 + 3
    for z in range(1, 4):  # runs of 16 zeros
        more = np.flatnonzero(run >= 16 * z)
        if len(more):
            codes, lengths = np.append(codes, np.full(len(more), table[1][0xF0])), np.append(lengths, np.full(len(more), table[2][0xF0]))
            block, place = np.append(block, block[more]), np.append(place, flat[more] * 4 + z - 1)
    last = v[:, -1] == 0
    if last.any() or len(place) != len(flat):
        end = np.flatnonzero(last)
        codes, lengths = np.append(codes, np.full(len(end), table[1][0])), np.append(lengths, np.full(len(end), table[2][0]))
        block, place = np.append(block, end), np.append(place, (end * width + width - 1) * 4 + 3)
        order = np.argsort(place, kind="stable")
        codes, lengths, block = codes[order], lengths[order], block[order]
    return codes, lengths, block


def _ac_fine(coefs: np.ndarray, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last bit of a band of at most 15 coefficients whose other bits are sent."""
    n, width = coefs.shape
    size = np.abs(coefs)
    new, old, none = size == 1, size > 1, size == 0
    target = np.where(new, np.arange(width), width)  # the next new coefficient at or after each place
    target = np.minimum.accumulate(target[:, ::-1], axis=1)[:, ::-1]
    zeros = np.cumsum(none, axis=1)
    b, k = np.nonzero(new)
    upto = zeros[b, k]
    same = np.concatenate([[False], b[1:] == b[:-1]])
    run = upto - np.where(same, np.concatenate([[0], upto[:-1]]), 0)
    codes, lengths = table[1][16 * run + 1] << 1 | (coefs[b, k] > 0), table[2][16 * run + 1] + 1
    place = (b * (width + 1) + k) * 32
    ob, ok = np.nonzero(old)
    ot = target[ob, ok]
    codes, lengths = np.append(codes, size[ob, ok] & 1), np.append(lengths, np.ones(len(ob), np.int64))
    place = np.append(place, (ob * (width + 1) + ot) * 32 + 1 + ok)
    eb = np.flatnonzero(target[:, -1] == width)  # something after the last new one
    codes, lengths = np.append(codes, np.full(len(eb), table[1][0])), np.append(lengths, np.full(len(eb), table[2][0]))
    place = np.append(place, (eb * (width + 1) + width) * 32)
    order = np.argsort(place, kind="stable")
    return codes[order], lengths[order], np.concatenate([b, ob, eb])[order]


def _marker(code: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, code, len(body) + 2) + body


def _sos(parts: list[tuple[int, int]], ss: int, se: int, ah: int, al: int) -> bytes:
    return _marker(0xDA, bytes([len(parts)]) + b"".join(bytes([c, t]) for c, t in parts) + bytes([ss, se, ah << 4 | al]))


_HEAD = b"\xff\xd8" + _marker(0xDB, b"\0" + bytes([QUANT]) * 64)


def _tables(ac, low) -> bytes:
    return _marker(0xC4, b"\x00" + DC_TABLE[0] + b"\x10" + ac[0] + b"\x11" + low[0] + b"\x12" + FINE_TABLE[0]) + _marker(0xDD, struct.pack(">H", RESTART))


def grid(mcus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns, rows) of MCUs that hold so many."""
    cols = np.clip(mcus, 1, np.maximum(64, np.ceil(np.sqrt(mcus))).astype(np.int64))
    return cols, -(-mcus // cols)


def raster(cols: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of all MCUs of all images: image, and the block of each of its six parts
    as a place in its component's raster order over all images; (mcu, 6) of those."""
    n = cols * rows
    image = np.repeat(np.arange(len(n)), n)
    m = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    r, c = m // cols[image], m % cols[image]
    base = (np.cumsum(n) - n)[image]
    luma = [4 * base + (2 * r + j // 2) * 2 * cols[image] + 2 * c + j % 2 for j in range(4)]
    return image, base + r * cols[image] + c, luma


def encode(blocks: np.ndarray, counts: np.ndarray, comments: list[bytes]) -> list[bytes]:
    """JPEG files of images of 4:2:0 MCUs.

    ``blocks`` (mcus, 6, 64) are zigzag coefficients of all MCUs of all images,
    ``counts`` the MCUs of each image, which must fill its :func:`grid`.
    """
    cols, rows = grid(counts)
    image, chroma_at, luma_at = raster(cols, rows)
    total = len(blocks)
    luma = np.empty((4 * total, 64), dtype=np.int32)
    for j in range(4):
        luma[luma_at[j]] = blocks[:, j]
    planes = [luma, blocks[:, 4].astype(np.int32), blocks[:, 5].astype(np.int32)]
    zeros = (blocks == 0).sum(axis=2)
    short = bool(((zeros == 0) | (zeros == 64)).all()) and int(np.abs(blocks).max(initial=0)) < 256
    ac, low_ac = (SHORT_TABLE, SHORT_LOW) if short else (AC_TABLE, LOW_TABLE)
    of_block = [np.repeat(np.arange(len(counts)), counts * k) for k in (4, 1, 1)]
    scans: list[_Scan] = []

    def segments(image: np.ndarray, per: np.ndarray, unit: int) -> tuple[np.ndarray, np.ndarray]:
        """Segment of each block, ``unit`` blocks to an MCU; segments per image."""
        n = -(-(per // unit) // RESTART)
        inside = (np.arange(len(image)) - np.repeat(np.cumsum(per) - per, per)) // unit
        return (np.cumsum(n) - n)[image] + inside // RESTART, n

    mcu_dc = blocks[:, :, 0].astype(np.int32).reshape(-1)
    seg, per = segments(np.repeat(image, 6), 6 * counts, 6)
    comp = np.tile([0, 0, 0, 0, 1, 2], total)
    codes, lengths = _dc_first(mcu_dc, np.arange(len(mcu_dc)), comp, seg)
    scans.append(_Scan(codes, lengths, seg, per, _sos([(1, 0), (2, 0), (3, 0)], 0, 0, 0, 1)))
    for c in range(3):
        sg, per_c = segments(of_block[c], counts * (4, 1, 1)[c], 1)
        for ss, se, low in BANDS:
            codes, lengths, block = _ac_first(planes[c][:, ss : se + 1], low, low_ac if low else ac)
            scans.append(_Scan(codes, lengths, sg[block], per_c, _sos([(c + 1, 1 if low else 0)], ss, se, 0, low)))
    scans.append(_Scan(mcu_dc & 1, np.ones(len(mcu_dc), np.int64), seg, per, _sos([(1, 0), (2, 0), (3, 0)], 0, 0, 1, 0)))
    for c in range(3):
        sg, per_c = segments(of_block[c], counts * (4, 1, 1)[c], 1)
        for ss, se, low in BANDS:
            if low:
                codes, lengths, block = _ac_fine(planes[c][:, ss : se + 1], FINE_TABLE)
                scans.append(_Scan(codes, lengths, sg[block], per_c, _sos([(c + 1, 2)], ss, se, 1, 0)))

    parts: list[list[bytes]] = [[] for _ in counts]
    for scan in scans:
        ends = np.cumsum(scan.per_image)
        data, starts = _pack(scan.codes, scan.lengths, scan.segment, int(ends[-1]))
        inside = np.arange(int(ends[-1])) - np.repeat(ends - scan.per_image, scan.per_image)
        data, begins = _stuffed(data, starts, inside - 1)
        raw = data.tobytes()
        for i, end in enumerate(ends.tolist()):
            parts[i] += (scan.head, raw[begins[end - scan.per_image[i]] : begins[end]])
    out = []
    for i, comment in enumerate(comments):
        frame = struct.pack(">BHHB", 8, 16 * int(rows[i]), 16 * int(cols[i]), 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
        out.append(_HEAD + _marker(0xFE, comment) + _marker(0xC2, frame) + _tables(ac, low_ac) + b"".join(parts[i]) + b"\xff\xd9")
    return out


# --- decoder --------------------------------------------------------------


@dataclass
class Component:
    ident: int
    h: int
    v: int
    quant: int
    base: int = 0  # its first block over all images
    stride: int = 0  # blocks in a padded row
    across: int = 0  # blocks in a row of scans of this component alone
    down: int = 0


@dataclass
class Image:
    width: int = 0
    height: int = 0
    comments: list[bytes] = field(default_factory=list)
    components: list[Component] = field(default_factory=list)
    quants: dict[int, np.ndarray] = field(default_factory=dict)
    hmax: int = 1
    vmax: int = 1
    mcu_cols: int = 0
    mcu_rows: int = 0


@dataclass
class _Part:
    """A scan of one image: its entropy bytes and how to read them."""

    start: int
    end: int
    ss: int
    se: int
    ah: int
    al: int
    tables: list[int]  # by part of an MCU
    parts: list[int]  # component of each part
    blocks: np.ndarray  # (MCUs * parts) blocks in order, from ``base`` on
    base: int
    restart: int


def _blocks_of(image: Image, comps: list[Component]) -> np.ndarray:
    if len(comps) == 1:
        c = comps[0]
        return (c.base + np.arange(c.down)[:, None] * c.stride + np.arange(c.across)[None, :]).reshape(-1)
    m = np.arange(image.mcu_cols * image.mcu_rows)
    r, k = m // image.mcu_cols, m % image.mcu_cols
    return np.stack([c.base + (r * c.v + y) * c.stride + k * c.h + x for c in comps for y in range(c.v) for x in range(c.h)], axis=1).reshape(-1)


def _huffman(body: bytes, tables: list[np.ndarray], known: dict[bytes, int]) -> dict[int, int]:
    out, q = {}, 0
    while q < len(body):
        n = 17 + sum(body[q + 1 : q + 17])
        spec = body[q + 1 : q + n]
        if spec not in known:
            known[spec] = len(tables)
            tables.append(lookup(spec))
        out[body[q]] = known[spec]
        q += n
    return out


def _quants(body: bytes) -> dict[int, np.ndarray]:
    out, q = {}, 0
    while q < len(body):
        wide, n = body[q] >> 4, 128 if body[q] >> 4 else 64
        out[body[q] & 15] = np.frombuffer(body[q + 1 : q + 1 + n], dtype=">u2" if wide else np.uint8).astype(np.float32)
        q += 1 + n
    return out


def parse(files: list[bytes]) -> tuple[np.ndarray, list[Image], list[_Part], list[np.ndarray], int]:
    """(all bytes, images, scans, Huffman tables, blocks).  What equal header
    segments say is worked out once."""
    buf = np.frombuffer(b"".join(files) + b"\xff\xd9" * 8, dtype=np.uint8)
    full = np.flatnonzero(buf[:-1] == 255)
    after = buf[full + 1]
    markers = full[(after != 0) & (after != 255) & ((after & 0xF8) != 0xD0)].tolist()
    images, scans, tables, known, blocks, at = [], [], [], {}, 0, 0
    huffman_of: dict[bytes, dict[int, int]] = {}
    quants_of: dict[bytes, dict[int, np.ndarray]] = {}
    scan_of: dict[tuple, tuple] = {}
    for raw in files:
        image, huffman, restart, p, end = Image(), {}, 0, 2, len(raw)
        origin = blocks
        frame, specs = b"", b""
        if raw[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        while p < end:
            code = raw[p + 1]
            if raw[p] != 255 or code == 0xD9:
                break
            size = int.from_bytes(raw[p + 2 : p + 4], "big")
            body = raw[p + 4 : p + 2 + size]
            p += 2 + size
            if code == 0xDA:
                key = (frame, specs, body)
                if key not in scan_of:
                    comps, table, parts = [], [], []
                    for q in range(body[0]):
                        n, c = next((n, x) for n, x in enumerate(image.components) if x.ident == body[1 + 2 * q])
                        comps.append(c)
                        pick, times = body[2 + 2 * q], 1 if body[0] == 1 else c.h * c.v
                        table += [huffman.get(16 + (pick & 15) if body[-3] > 0 else pick >> 4, 0)] * times
                        parts += [n] * times
                    scan_of[key] = (body[-3], body[-2], body[-1] >> 4, body[-1] & 15, table, parts, _blocks_of(image, comps) - origin)
                stop = markers[bisect.bisect_left(markers, at + p)]
                scans.append(_Part(at + p, stop, *scan_of[key], origin, restart))
                p = stop - at
            elif code == 0xDB:
                if body not in quants_of:
                    quants_of[body] = _quants(body)
                image.quants |= quants_of[body]
            elif code == 0xC4:
                if body not in huffman_of:
                    huffman_of[body] = _huffman(body, tables, known)
                huffman |= huffman_of[body]
                specs += body
            elif code == 0xDD:
                restart = int.from_bytes(body, "big")
            elif code == 0xFE:
                image.comments.append(body)
            elif code == 0xC2:
                frame = body
                image.height, image.width = struct.unpack(">HH", body[1:5])
                image.components = [Component(body[q], body[q + 1] >> 4, body[q + 1] & 15, body[q + 2]) for q in range(6, len(body), 3)]
                image.hmax, image.vmax = max(c.h for c in image.components), max(c.v for c in image.components)
                image.mcu_cols, image.mcu_rows = -(-image.width // (8 * image.hmax)), -(-image.height // (8 * image.vmax))
                for c in image.components:
                    c.base, c.stride = blocks, image.mcu_cols * c.h
                    c.across, c.down = -(-(-(-image.width * c.h // image.hmax)) // 8), -(-(-(-image.height * c.v // image.vmax)) // 8)
                    blocks += c.stride * image.mcu_rows * c.v
            elif 0xC0 <= code <= 0xCF and code not in (0xC8, 0xCC):
                raise ValueError("only progressive Huffman frames are read")
        images.append(image)
        at += len(raw)
    return buf, images, scans, tables, blocks


class _Streams:
    """Restart segments of scans of one kind, read in step."""

    def __init__(self, data: np.ndarray, scans: list[_Part], begins: list[np.ndarray]):
        self.words = np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))
        column = lambda f: np.array([f(x) for x in scans], dtype=np.int64)
        width, total, base, restart = column(lambda x: len(x.parts)), column(lambda x: len(x.blocks)), column(lambda x: x.base), column(lambda x: x.restart)
        n = total // np.maximum(width, 1)
        step = np.where(restart > 0, restart, n)
        count = -(-n // np.maximum(step, 1))
        if count.tolist() != [len(b) for b in begins]:
            raise ValueError("restart markers are missing")
        self.owner = owner = np.repeat(np.arange(len(scans)), count)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        self.blocks = np.concatenate([x.blocks for x in scans]) + np.repeat(base, total) if scans else np.zeros(0, np.int64)
        self.at = (np.cumsum(total) - total)[owner] + inside * (step * width)[owner]
        self.left = np.minimum(step[owner], n[owner] - inside * step[owner]) * width[owner]
        self.bit = 8 * np.concatenate(begins).astype(np.int64) if scans else np.zeros(0, np.int64)
        self.ss, self.se, self.al, self.width = column(lambda x: x.ss)[owner], column(lambda x: x.se)[owner], column(lambda x: x.al)[owner], width[owner]
        self.table = column(lambda x: x.tables[0])[owner]

    def peek(self, bit: np.ndarray) -> np.ndarray:
        """The next 57 bits at least, at the top."""
        return self.words[bit >> 3].astype(_U) << (bit & 7).astype(_U)


def _signed(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << np.maximum(size - 1, 0)), bits - (1 << size) + 1, bits)


def _take(word: np.ndarray, skip: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` bits after ``skip``."""
    return ((word << skip.astype(_U)) >> _U(1) >> (63 - size).astype(_U)).astype(np.int64)


def _decode_dc(s: _Streams, scans: list[_Part], tables: np.ndarray, coefs: np.ndarray) -> None:
    """First DC scans; the parts of an MCU may have tables and predictions of their own."""
    if not len(s.at):
        return
    most = int(s.width.max())
    prediction = np.zeros((len(s.at), most), np.int64)
    part_table, part_comp = np.zeros((len(scans), most), np.int64), np.zeros((len(scans), most), np.int64)
    for i, scan in enumerate(scans):
        part_table[i, : len(scan.tables)], part_comp[i, : len(scan.parts)] = scan.tables, scan.parts
    owner = s.owner
    bit, at, end = s.bit.copy(), s.at.copy(), s.at + s.left
    live = np.arange(len(at))
    step = 0
    while len(live):
        part = step % s.width[live]
        word = s.peek(bit[live])
        e = tables[part_table[owner[live], part], (word >> _U(48)).astype(np.int64)]
        length, size = e >> 8, e & 255
        value = _signed(_take(word, length, size), size)
        comp = part_comp[owner[live], part]
        prediction[live, comp] += value
        coefs[s.blocks[at[live]], 0] = prediction[live, comp] << s.al[live]
        bit[live] += length + size
        at[live] += 1
        step += 1
        live = live[at[live] < end[live]]


def _fine_dc(s: _Streams, coefs: np.ndarray) -> None:
    owner = np.repeat(np.arange(len(s.at)), s.left)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(s.left) - s.left, s.left)
    bit = s.bit[owner] + inside
    value = (s.peek(bit) >> _U(63)).astype(np.int64)
    coefs[s.blocks[s.at[owner] + inside], 0] |= (value << s.al[owner]).astype(coefs.dtype)


def _decode_ac(s: _Streams, tables: np.ndarray, coefs: np.ndarray) -> None:
    """First AC scans: one symbol of each stream in a pass."""
    flat = coefs.reshape(-1)
    bit, at, end = s.bit, s.at, s.at + s.left
    ss, se, al, base = s.ss, s.se, s.al, s.table << 16
    k = ss.copy()
    lut = tables.reshape(-1)
    while len(at):
        word = s.peek(bit)
        e = lut[base + (word >> _U(48)).astype(np.int64)]
        length, run, size = e >> 8, (e >> 4) & 15, e & 15
        value = _take(word, length, size)
        bit = bit + length + size
        k += run
        real = size > 0
        place = s.blocks[at] * 64 + k
        if real.all():
            flat[place] = _signed(value, size) << al
            k += 1
        else:
            flat[place[real]] = (_signed(value, size) << al)[real]
            k += real | (run == 15)
            over = np.flatnonzero(~real & (run < 15))  # end of band, for 2**run + bits blocks
            if len(over):
                extra = _take(word[over], length[over], run[over])
                bit[over] += run[over]
                at[over] += (1 << run[over]) + extra - 1
                k[over] = 64
        done = k > se
        if done.any():
            at = at + done
            k = np.where(done, ss, k)
            if (gone := at >= end).any():
                keep = ~gone
                bit, at, end, ss, se, al, base, k = (x[keep] for x in (bit, at, end, ss, se, al, base, k))


def _fine_ac(s: _Streams, tables: np.ndarray, coefs: np.ndarray) -> None:
    """Refinement AC scans: each pass reads a symbol or passes one coefficient."""
    flat = coefs.reshape(-1)
    bit, at, end = s.bit, s.at, s.at + s.left
    ss, se, al, base = s.ss, s.se, s.al, s.table << 16
    k, run, new, over = ss.copy(), np.full(len(at), -1), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    lut = tables.reshape(-1)
    # run: zeros still to pass before ``new`` is placed, -1: a symbol is next; over: blocks of end of band
    while len(at):
        ask = np.flatnonzero((run < 0) & (over == 0))
        if len(ask):
            word = s.peek(bit[ask])
            e = lut[base[ask] + (word >> _U(48)).astype(np.int64)]
            length, r, size = e >> 8, (e >> 4) & 15, e & 15
            sign = _take(word, length, np.ones_like(length))
            stop = (size == 0) & (r < 15)
            bit[ask] += length + np.where(stop, r, (size > 0).astype(np.int64))
            over[ask] = np.where(stop, (1 << r) + _take(word, length, np.where(stop, r, 0)), 0)
            run[ask] = np.where(stop, -1, r)
            new[ask] = np.where(size > 0, 2 * sign - 1, 0) << al[ask]
        place = s.blocks[at] * 64 + k
        held = flat[place].astype(np.int64)
        old = held != 0
        fix = np.flatnonzero(old)
        if len(fix):
            one = (s.peek(bit[fix]) >> _U(63)).astype(np.int64)
            bit[fix] += 1
            h = held[fix]
            flat[place[fix]] = np.where((one == 1) & ((np.abs(h) >> al[fix]) & 1 == 0), h + (np.sign(h) << al[fix]), h)
        put = ~old & (run == 0)
        if put.any():
            # a coefficient set in this scan gets no correction bit: it is passed at once
            flat[place[put]] = np.where(new[put] != 0, new[put], held[put])
        run = np.where(put, -1, np.where(~old & (run > 0), run - 1, run))
        k = k + 1
        done = k > se
        if done.any():
            over = np.where(done & (over > 0), over - 1, over)
            run = np.where(done, -1, run)
            at = at + done
            k = np.where(done, ss, k)
            if (gone := at >= end).any():
                keep = ~gone
                bit, at, end, ss, se, al, base, k, run, new, over = (x[keep] for x in (bit, at, end, ss, se, al, base, k, run, new, over))


def decode(files: list[bytes]) -> tuple[list[Image], np.ndarray]:
    """(images, coefficients): blocks in order, (blocks, 64) in zigzag order."""
    buf, images, scans, tables, blocks = parse(files)
    coefs = np.zeros((blocks, 64), dtype=np.int16)
    if not scans:
        return images, coefs
    first, last = np.array([s.start for s in scans]), np.array([s.end for s in scans])
    full = np.flatnonzero(buf[:-1] == 255)
    within = np.searchsorted(first, full, side="right") - 1
    full = full[(within >= 0) & (full < last[within])]
    stuffed, restarts = full[buf[full + 1] == 0], full[(buf[full + 1] & 0xF8) == 0xD0]
    drop = np.zeros(len(buf) + 1, dtype=np.int32)
    drop[stuffed + 1] = 1
    drop[restarts] = 1
    drop[restarts + 1] = 1
    data = np.append(buf[drop[:-1] == 0], np.zeros(16, np.uint8))
    gone = np.cumsum(drop) - drop
    places = np.sort(np.concatenate([first, restarts + 2]))
    owner = np.searchsorted(first, places, side="right") - 1
    begins = np.split(places - gone[places], np.searchsorted(owner, np.arange(1, len(scans))))
    lut = np.stack(tables).astype(np.int64) if tables else np.zeros((1, 1 << 16), np.int64)

    def streams(keep) -> tuple[_Streams, list[_Part]]:
        chosen = [i for i, x in enumerate(scans) if keep(x)]
        return _Streams(data, [scans[i] for i in chosen], [begins[i] for i in chosen]), [scans[i] for i in chosen]

    s, chosen = streams(lambda x: x.ss == 0 and x.ah == 0)
    _decode_dc(s, chosen, lut, coefs)
    _decode_ac(streams(lambda x: x.ss > 0 and x.ah == 0)[0], lut, coefs)
    for level in sorted({x.ah for x in scans if x.ah}, reverse=True):
        _fine_dc(streams(lambda x: x.ss == 0 and x.ah == level)[0], coefs)  # noqa: B023
        _fine_ac(streams(lambda x: x.ss > 0 and x.ah == level)[0], lut, coefs)  # noqa: B023
    return images, coefs


def _colours(y: np.ndarray, cb: np.ndarray, cr: np.ndarray) -> np.ndarray:
    """RGB of planes of samples of one shape, as a last axis."""
    cb, cr = cb - np.float32(128), cr - np.float32(128)
    out = np.empty((*y.shape, 3), dtype=np.uint8)
    for k, plane in enumerate((y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb)):
        out[..., k] = np.clip(np.rint(plane, out=plane), 0, 255, out=plane)
    return out


def _samples(coefs: np.ndarray, quant: np.ndarray) -> np.ndarray:
    whole = (coefs.astype(np.float32) * quant).reshape(-1, 64)
    kind = np.float32 if max(whole.max(initial=0), -whole.min(initial=0)) <= _MOST else np.float64
    out = whole.astype(kind, copy=False) @ IDCT.astype(kind)
    out *= kind(2.0**-BITS)
    out += kind(128)
    return np.clip(np.rint(out, out=out), 0, 255, out=out).astype(np.float32, copy=False)


def rgb(image: Image, coefs: np.ndarray) -> np.ndarray:
    """(height, width, 3) samples of one image, chroma replicated to full resolution."""
    planes = []
    for c in image.components:
        rows = image.mcu_rows * c.v
        block = _samples(coefs[c.base : c.base + c.stride * rows], image.quants[c.quant])
        plane = block.reshape(rows, c.stride, 8, 8).swapaxes(1, 2).reshape(8 * rows, 8 * c.stride)
        plane = plane.repeat(image.vmax // c.v, axis=0).repeat(image.hmax // c.h, axis=1)
        planes.append(plane[: image.height, : image.width])
    if len(planes) == 1:
        return np.stack(planes * 3, axis=2).astype(np.uint8)
    return _colours(*planes)


def mcu_rgb(blocks: np.ndarray, quants: np.ndarray) -> np.ndarray:
    """(mcus, 16, 16, 3) samples of 4:2:0 MCUs (mcus, 6, 64) of many images;
    ``quants`` are the tables of the six blocks, of all MCUs or of each."""
    n = len(blocks)
    samples = _samples(blocks, quants).reshape(n, 6, 8, 8)
    luma = samples[:, :4].reshape(n, 2, 2, 8, 8).swapaxes(2, 3).reshape(n, 16, 16)
    cb, cr = (samples[:, j].repeat(2, axis=1).repeat(2, axis=2) for j in (4, 5))
    return _colours(luma, cb, cr)
