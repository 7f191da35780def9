"""Media columns: FLAC streams written and read with numpy, many frames at a time.

A stream is ``fLaC``, STREAMINFO (with the MD5 of the samples), a SEEKTABLE with one point per
frame, and mono frames of ``BLOCK`` samples. Encoding tries verbatim, the fixed predictors of order
0 to 2 and a quantised linear predictor of order 2, with one Rice parameter per frame. Decoding
reads Rice residuals and linear predictors of any order of all frames in lockstep: step *i* decodes
sample *i* of every frame, so Python's cost is per step and not per sample. Header CRC-8 and frame CRC-16
are verified, and the samples' MD5 as well. Decoding covers mono streams of up to 16 bits and fixed block
size, with all subframe types, Rice partitions, escape codes and wasted bits; others raise ``ValueError``.
``read_range`` seeks: it finds the frames of a range of samples by the seek table and decodes no others.

Nulls and edges: a null medium gives one row of null results; a damaged stream gives one row with an ``error`` and null
results, and its neighbours are read; a stream without samples has one empty block; repeated rows are decoded as often as
they come; long media cost memory by batch.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import anti_clash, crc32, slices

BLOCK = 1024
_LPC_SHIFT, _LPC_BITS = 6, 9


def _table(poly: int, width: int) -> np.ndarray:
    """CRC steps for one byte, from the polynomial."""
    out, top, mask = np.arange(256, dtype=np.uint32) << (width - 8), 1 << (width - 1), (1 << width) - 1
    for _ in range(8):
        out = np.where(out & top, (out << 1) ^ poly, out << 1) & mask
    return out


_CRC8 = _table(0x07, 8).astype(np.uint8).tolist()
_CRC16 = _table(0x8005, 16).astype(np.uint16)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = _CRC8[c ^ b]
    return c


def crc16_many(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-16 of many byte ranges at once."""
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    crc = np.zeros(len(starts), np.uint16)
    live = len(at)
    for i in range(int(left[0]) if len(left) else 0):
        while live and left[live - 1] <= i:
            live -= 1
        c = crc[:live]
        crc[:live] = (c << np.uint16(8)) ^ _CRC16[(c >> np.uint16(8)) ^ data[at[:live] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _utf8_number(n: int) -> bytes:
    """A frame number in the extended UTF-8 form of the frame header."""
    if n < 0x80:
        return bytes([n])
    tail = []
    while True:
        tail.append(0x80 | (n & 0x3F))
        n >>= 6
        if n < (1 << (6 - len(tail))):
            break
    lead = (0xFF << (7 - len(tail))) & 0xFF
    return bytes([lead | n, *reversed(tail)])


# --- encoding ----------------------------------------------------------------------------------


def _residuals(x: np.ndarray, coef: np.ndarray, shift: int) -> np.ndarray:
    """Residuals of a predictor over rows of samples; ``coef`` is one row, or one per row."""
    out = np.zeros_like(x)
    order = coef.shape[1]
    pred = np.zeros((len(x), x.shape[1] - order), x.dtype)
    for j in range(order):
        pred += coef[:, j : j + 1] * x[:, order - 1 - j : x.shape[1] - 1 - j]
    out[:, order:] = x[:, order:] - (pred >> shift)
    return out


_FIXED = [np.zeros((1, 0), np.int64), np.array([[1]]), np.array([[2, -1]]), np.array([[3, -3, 1]]), np.array([[4, -6, 4, -1]])]


def _least_squares(x: np.ndarray) -> np.ndarray:
    """Quantised order-2 coefficients of each row from its autocorrelation."""
    y = x.astype(np.float64)
    r0, r1, r2 = (y * y).sum(1), (y[:, 1:] * y[:, :-1]).sum(1), (y[:, 2:] * y[:, :-2]).sum(1)
    det = r0 * r0 - r1 * r1
    ok = det > 1e-9
    det = np.where(ok, det, 1.0)
    a, b = np.where(ok, r1 * (r0 - r2) / det, 0.0), np.where(ok, (r0 * r2 - r1 * r1) / det, 0.0)
    top = (1 << (_LPC_BITS - 1)) - 1
    return np.clip(np.rint(np.stack([a, b], 1) * (1 << _LPC_SHIFT)), -top, top).astype(np.int64)


def _put_bits(bits: np.ndarray, at: np.ndarray, value: np.ndarray, width: np.ndarray | int) -> None:
    """Writes unsigned values of up to 32 bits, most significant bit first."""
    width = np.broadcast_to(width, at.shape)
    for k in range(int(width.max()) if len(at) else 0):
        sel = width > k
        bits[at[sel] + width[sel] - 1 - k] = (value[sel] >> k) & 1


def _frames(samples: np.ndarray, first: np.ndarray, size: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encodes frames of equal length ``size[0]``; returns all their bytes and each one's length."""
    n, f = int(size[0]), len(size)
    x = samples[first[:, None] + np.arange(n)].astype(np.int32)
    choices = [(8 + k, _FIXED[k], 0) for k in range(3) if n > k]
    if n > 32:
        choices.append((32 + 1, _least_squares(x), _LPC_SHIFT))
    cost = np.full((f, len(choices) + 1), 1 << 40, np.int64)
    cost[:, 0] = 8 * n
    all_res, all_k = [], []
    for c, (kind, coef, shift) in enumerate(choices, 1):
        order = coef.shape[1]
        e = _residuals(x, coef.astype(np.int32), shift)
        u = (e << 1) ^ (e >> 31)
        u[:, :order] = 0
        total = u.sum(axis=1, dtype=np.int64)
        k = np.clip(np.floor(np.log2(np.maximum(total / max(1, n - order), 1) * 0.75)), 0, 14).astype(np.int64)
        cost[:, c] = (total >> k) + (n - order) * (1 + k) + 8 * order + 10 + (9 + _LPC_BITS * order if kind >= 32 else 0)
        all_res.append(u)
        all_k.append(k)
    pick = cost.argmin(axis=1)
    order_of = np.array([0, *[c[1].shape[1] for c in choices]])
    # headers: sync, block size code 7 (16 bits), rate code 0 (as STREAMINFO), mono, 8 bits
    heads = []
    for num in number.tolist():
        h = b"\xff\xf8\x70\x02" + _utf8_number(num) + struct.pack(">H", n - 1)
        heads.append(h + bytes([crc8(h)]))
    head_len = np.array([len(h) for h in heads])
    body_bits = np.full(f, 8 + 8 * n)
    for c, (kind, coef, _) in enumerate(choices, 1):  # the sums above are estimates; these are the lengths
        rows = np.flatnonzero(pick == c)
        if len(rows):
            order, k = coef.shape[1], all_k[c - 1][rows]
            quotients = (all_res[c - 1][rows] >> k[:, None].astype(np.int32)).sum(axis=1, dtype=np.int64)
            body_bits[rows] = 18 + 8 * order + (9 + _LPC_BITS * order if kind >= 32 else 0) + quotients + (n - order) * (1 + k)
    body_len = (body_bits + 7) >> 3
    total = head_len + body_len + 2
    begin = np.cumsum(total) - total
    bits = np.zeros(int(total.sum()) * 8, np.uint8)
    kinds = np.array([1, *[c[0] for c in choices]])
    body = (begin + head_len) * 8
    _put_bits(bits, body, kinds[pick] << 1, 8)
    raw = np.flatnonzero(pick == 0)
    for c, (kind, coef, _) in enumerate(choices, 1):
        rows = np.flatnonzero(pick == c)
        if not len(rows):
            continue
        order = int(order_of[c])
        at = body[rows] + 8
        for j in range(order):
            _put_bits(bits, at, x[rows, j] & 0xFF, 8)
            at = at + 8
        if kind >= 32:
            _put_bits(bits, at, np.full(len(rows), _LPC_BITS - 1), 4)
            _put_bits(bits, at + 4, np.full(len(rows), _LPC_SHIFT), 5)
            at = at + 9
            for j in range(order):
                _put_bits(bits, at, coef[rows, j] & ((1 << _LPC_BITS) - 1), _LPC_BITS)
                at = at + _LPC_BITS
        k = all_k[c - 1][rows]
        _put_bits(bits, at + 6, k, 4)  # method 0, partition order 0
        at = at + 10
        for one in np.unique(k).tolist():
            same = np.flatnonzero(k == one)
            u = all_res[c - 1][rows[same]][:, order:]
            q = (u >> one).astype(np.int64)
            stop = (at[same][:, None] + np.cumsum(q + (1 + one), axis=1) - (1 + one)).ravel()
            bits[stop] = 1
            low = (u & ((1 << one) - 1)).astype(np.uint16).ravel()
            for b in range(one):
                stop += 1
                bits[stop] = (low >> (one - 1 - b)) & 1
    out = np.packbits(bits)
    if len(raw):
        out[(begin + head_len + 1)[raw][:, None] + np.arange(n)] = x[raw] & 0xFF
    for b, h in zip(begin.tolist(), heads, strict=True):
        out[b : b + len(h)] = np.frombuffer(h, np.uint8)
    crc = crc16_many(out, begin, total - 2)
    out[begin + total - 2], out[begin + total - 1] = crc >> 8, crc & 0xFF
    return out, total


def encode_streams(payloads: list[bytes], rate: int = 8000, block: int = BLOCK) -> list[bytes]:
    """FLAC streams of 8-bit mono samples; an unsigned payload byte b is the sample b - 128."""
    data = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int16) - 128
    sizes = np.array([len(p) for p in payloads], np.int64)
    base = np.cumsum(sizes) - sizes
    n_frames = -(-sizes // block)
    stream = np.repeat(np.arange(len(payloads)), n_frames)
    number = np.arange(int(n_frames.sum())) - np.repeat(np.cumsum(n_frames) - n_frames, n_frames)
    first = base[stream] + number * block
    size = np.minimum(block, sizes[stream] - number * block)
    made: list[bytes] = [b""] * len(stream)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for lo in range(0, len(at), 2048):
            part = at[lo : lo + 2048]
            out, total = _frames(data, first[part], size[part], number[part])
            ends = np.cumsum(total)
            raw = out.tobytes()
            for i, a, b in zip(part.tolist(), (ends - total).tolist(), ends.tolist(), strict=True):
                made[i] = raw[a:b]
    result, at = [], 0
    for p, count in zip(payloads, n_frames.tolist(), strict=True):
        frames = made[at : at + count]
        at += count
        lens = [len(f) for f in frames] or [0]
        info = struct.pack(">HH", block, block) + struct.pack(">I", min(lens))[1:] + struct.pack(">I", max(lens))[1:]
        info += struct.pack(">Q", (rate << 44) | (0 << 41) | (7 << 36) | len(p))
        signed = (np.frombuffer(p, np.uint8) ^ 0x80).tobytes()
        info += hashlib.md5(signed).digest()
        points, offset = [], 0
        for k, f in enumerate(frames):
            points.append(struct.pack(">QQH", k * block, offset, min(block, len(p) - k * block)))
            offset += len(f)
        seek = b"".join(points)
        result.append(b"fLaC\x00\x00\x00\x22" + info + b"\x83" + struct.pack(">I", len(seek))[1:] + seek + b"".join(frames))
    return result


# --- decoding ----------------------------------------------------------------------------------


class _Stream:
    """What the metadata blocks of a stream say."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        at, self.points, self.total = 4, [], None
        last = False
        while not last:
            last, kind, size = bool(raw[at] & 0x80), raw[at] & 0x7F, int.from_bytes(raw[at + 1 : at + 4], "big")
            body = raw[at + 4 : at + 4 + size]
            if kind == 0:
                self.block, top = struct.unpack(">HH", body[:4])
                packed = int.from_bytes(body[10:18], "big")
                self.rate, self.channels, self.bits, self.total = packed >> 44, ((packed >> 41) & 7) + 1, ((packed >> 36) & 31) + 1, packed & ((1 << 36) - 1)
                self.md5 = body[18:34]
                if top != self.block or self.channels != 1 or self.bits > 16:
                    raise ValueError("only mono streams of fixed block size and up to 16 bits are read")
            elif kind == 3:
                for s, o, n in struct.iter_unpack(">QQH", body[: size // 18 * 18]):
                    if s != (1 << 64) - 1:
                        self.points.append((s, o, n))
            at += 4 + size
        self.first = at
        self.known = len(self.points) == -(-self.total // self.block) if self.total else False


def _read_header(raw: memoryview | bytes, at: int, s: _Stream) -> tuple[int, int]:
    """Checks a frame header; returns its length and the frame's number of samples."""
    if raw[at] != 0xFF or raw[at + 1] != 0xF8:
        raise ValueError("lost frame sync")
    size_code, rate_code = raw[at + 2] >> 4, raw[at + 2] & 15
    end, lead = at + 5, raw[at + 4]
    while lead & 0x80 and lead & 0x40:
        end, lead = end + 1, lead << 1
    if size_code == 6:
        n, end = raw[end] + 1, end + 1
    elif size_code == 7:
        n, end = (raw[end] << 8 | raw[end + 1]) + 1, end + 2
    elif size_code == 1:
        n = 192
    else:
        n = 576 << (size_code - 2) if size_code < 6 else 256 << (size_code - 8)
    end += {12: 1, 13: 2, 14: 2}.get(rate_code, 0)
    if crc8(bytes(raw[at:end])) != raw[end]:
        raise ValueError("frame header checksum")
    return end + 1 - at, n


class _Bits:
    """Bit reads at many places of one byte array."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        self.words = np.zeros(len(padded) - 8, np.uint64)
        for k in range(8):
            self.words |= padded[k : k + len(self.words)].astype(np.uint64) << np.uint64(56 - 8 * k)

    def peek(self, at: np.ndarray) -> np.ndarray:
        """At least 57 bits from each bit position, left aligned."""
        return self.words[at >> 3] << (at & 7).astype(np.uint64)

    def take(self, at: np.ndarray, width: int | np.ndarray) -> np.ndarray:
        w = np.asarray(width, np.uint64)
        return np.where(w > 0, (self.peek(at) >> np.uint64(1)) >> (np.uint64(63) - w), 0).astype(np.int64)

    def take_signed(self, at: np.ndarray, width: int | np.ndarray) -> np.ndarray:
        v, w = self.take(at, width), np.asarray(width, np.int64)
        return np.where((w > 0) & (v >= 1 << np.maximum(w - 1, 0)), v - (np.int64(1) << w), v)

    def unary(self, at: np.ndarray) -> np.ndarray:
        """Zeros before the next one."""
        hi = (self.peek(at) >> np.uint64(25)).astype(np.float64)  # 39 bits fit a double exactly
        zeros = 39 - np.frexp(hi)[1].astype(np.int64)
        empty = np.flatnonzero(hi == 0)
        if len(empty):
            zeros[empty] = 39 + self.unary(at[empty] + 39)
        return zeros


def _decode_frames(bits: _Bits, data: np.ndarray, at: np.ndarray, head: np.ndarray, size: np.ndarray, bps: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Decodes one frame at each byte place; returns samples by frame and the byte after each frame's subframe."""
    f = len(at)
    pos = (at + head) * 8
    kind = bits.take(pos + 1, 6)
    wasted = bits.take(pos + 7, 1)
    pos = pos + 8
    if wasted.any():  # that many low bits of every sample are zero and not stored
        sel = np.flatnonzero(wasted)
        wasted[sel] = bits.unary(pos[sel]) + 1
        pos[sel] += wasted[sel]
        bps = bps - wasted
    order = np.where(kind >= 32, kind - 31, np.where((kind >= 8) & (kind <= 12), kind - 8, 0))
    coded = kind >= 8
    if ((kind > 1) & (kind < 8) | (kind > 12) & (kind < 32)).any():
        raise ValueError("reserved subframe type")
    rows = np.argsort(-np.where(coded, size, 0), kind="stable")
    wide = int(size.max())
    out = np.zeros((wide, f), np.int32)  # by step, so that a step writes one row
    n_coded = int(coded.sum())
    for r in rows[n_coded:].tolist():
        n = int(size[r])
        if kind[r] == 0:
            out[:n, r] = bits.take_signed(pos[r : r + 1], bps[r])[0]
            pos[r] += bps[r]
        elif bps[r] == 8:
            out[:n, r] = data[pos[r] >> 3 : (pos[r] >> 3) + n].view(np.int8)
            pos[r] += 8 * n
        else:
            out[:n, r] = bits.take_signed(pos[r] + bps[r] * np.arange(n), bps[r])
            pos[r] += bps[r] * n
    rows = rows[:n_coded]
    if n_coded:
        p, b, o, n, knd = pos[rows], bps[rows], order[rows], size[rows], kind[rows]
        top = int(o.max())
        hist = np.zeros((max(top, 1), n_coded), np.int64)  # hist[0] is the latest sample
        got = np.zeros((wide, n_coded), np.int32)
        for i in range(top):  # warm-up samples
            sel = np.flatnonzero(o > i)
            v = bits.take_signed(p[sel], b[sel])
            p[sel] += b[sel]
            hist[1:, sel] = hist[:-1, sel]
            hist[0, sel] = v
            got[i, sel] = v
        coef, shift = np.zeros((max(top, 1), n_coded), np.int64), np.zeros(n_coded, np.int64)
        for k in range(5):
            sel = np.flatnonzero(knd == 8 + k)
            if k and len(sel):
                coef[:k, sel] = _FIXED[k][0][:, None]
        lpc = np.flatnonzero(knd >= 32)
        if len(lpc):
            prec = bits.take(p[lpc], 4) + 1
            shift[lpc] = bits.take_signed(p[lpc] + 4, 5)
            p[lpc] += 9
            for j in range(top):
                sel = lpc[o[lpc] > j]
                w = prec[o[lpc] > j]
                coef[j, sel] = bits.take_signed(p[sel], w)
                p[sel] += w
        long_codes = bits.take(p, 2)
        param_bits = 4 + long_codes
        part = n >> bits.take(p + 2, 4)
        p += 6
        k, escape = np.zeros(n_coded, np.int64), np.full(n_coded, -1, np.int64)

        def parameters(sel: np.ndarray) -> None:
            k[sel] = bits.take(p[sel], param_bits[sel])
            p[sel] += param_bits[sel]
            escape[sel] = -1
            esc = sel[k[sel] == (1 << param_bits[sel]) - 1]
            if len(esc):
                escape[esc] = bits.take(p[esc], 5)
                p[esc] += 5

        parameters(np.arange(n_coded))
        split = bool((part < n).any())
        lo = int(o.min())
        live = n_coded
        any_escape = bool((escape >= 0).any())
        for i in range(lo, wide):
            while live and n[live - 1] <= i:
                live -= 1
            if not live:
                break
            if split and i:
                new = np.flatnonzero((i % part[:live] == 0) & (i >= o[:live]) & (i > 0))
                new = new[part[new] <= i]
                if len(new):
                    parameters(new)
                    any_escape = bool((escape >= 0).any())
            a = slice(0, live) if i >= top else np.flatnonzero(o[:live] <= i)
            pa_, ka = p[a], k[a]
            q = bits.unary(pa_)
            ku = ka.astype(np.uint64)
            start = pa_ + q + 1
            u = (q << ka) | ((bits.peek(start) >> np.uint64(1)) >> (np.uint64(63) - ku)).astype(np.int64)
            e = (u >> 1) ^ -(u & 1)
            nxt = start + ka
            if any_escape:
                esc = escape[a]
                e = np.where(esc >= 0, bits.take_signed(pa_, np.maximum(esc, 0)), e)
                nxt = np.where(esc >= 0, pa_ + np.maximum(esc, 0), nxt)
            p[a] = nxt
            pred = coef[0][a] * hist[0][a]
            for j in range(1, top):
                pred += coef[j][a] * hist[j][a]
            v = e + (pred >> shift[a])
            for j in range(top - 1, 0, -1):
                hist[j][a] = hist[j - 1][a]
            hist[0][a] = v
            got[i][a] = v
        out[:, rows] = got
        pos[rows] = p
    out <<= wasted.astype(np.int32)
    turned = np.ascontiguousarray(out.T)
    return [turned[r, : int(size[r])] for r in range(f)], (pos + 7) >> 3


def decode_streams(media: list[bytes], width: int = 4096, ranges: list[tuple[int, int]] | None = None) -> list[tuple[_Stream, list[tuple[int, np.ndarray]]]]:
    """For each stream its description and its blocks (sample offset, samples); raises where a checksum fails.

    Streams with a complete seek table are decoded over all their frames together, others frame after frame. With ``ranges``
    (first sample, end) only the blocks that reach into each stream's range come back, found by its seek table; the MD5 of all
    samples is then not checked.
    """
    infos = [_Stream(m) for m in media]
    lens = np.array([len(m) for m in media], np.int64)
    base = (np.cumsum(lens) - lens).tolist()
    raw = b"".join(media)
    data, bits = np.frombuffer(raw, np.uint8), None
    bits = _Bits(data)
    blocks: list[list] = [[] for _ in media]
    todo = []  # (stream, byte place, sample offset)
    for k, s in enumerate(infos):
        if s.known:
            lo, hi = ranges[k] if ranges else (0, s.total)
            todo += [(k, base[k] + s.first + o, first) for first, o, n in s.points if first < hi and first + n > lo]
        elif s.total != 0 or s.first < len(media[k]):
            if s.first < len(media[k]):
                todo.append((k, base[k] + s.first, 0))
    while todo:
        now, todo = todo[:width], todo[width:]
        heads = [_read_header(raw, at, infos[k]) for k, at, _ in now]
        at = np.array([a for _, a, _ in now], np.int64)
        head, size = (np.array(x, np.int64) for x in zip(*heads, strict=True))
        samples, ends = _decode_frames(bits, data, at, head, size, np.array([infos[k].bits for k, _, _ in now], np.int64))
        want = crc16_many(data, at, ends - at)
        if (want != (data[ends].astype(np.uint16) << 8 | data[ends + 1])).any():
            raise ValueError("frame checksum")
        for (k, _, first), x, end in zip(now, samples, (ends + 2).tolist(), strict=True):
            blocks[k].append((first, x))
            if not infos[k].known and end < base[k] + len(media[k]):
                todo.append((k, end, first + len(x)))
    for s, found in zip(infos, blocks, strict=True):
        found.sort(key=lambda b: b[0])
        if ranges:
            continue
        kind = np.int8 if s.bits <= 8 else np.dtype("<i2")
        joined = b"".join(x.astype(kind).tobytes() for _, x in found)
        if s.md5 != b"\0" * 16 and hashlib.md5(joined).digest() != s.md5:
            raise ValueError("the samples' MD5 does not match")
    return list(zip(infos, blocks, strict=True))


def pcm_bytes(s: _Stream, blocks: list[tuple[int, np.ndarray]]) -> bytes:
    """Signed little-endian PCM of blocks that follow each other."""
    kind, at, out = np.int8 if s.bits <= 8 else np.dtype("<i2"), blocks[0][0] if blocks else 0, []
    for first, x in blocks:
        if first != at:
            raise ValueError("blocks with a gap")
        at += len(x)
        out.append(x.astype(kind).tobytes())
    return b"".join(out)


def read_range(media: list[bytes], starts: list[int], ends: list[int]) -> list[np.ndarray]:
    """The samples from ``start`` to before ``end`` of each stream, by sample offset: other frames are not decoded."""
    out = []
    for (_, blocks), lo, hi in zip(decode_streams(media, ranges=list(zip(starts, ends, strict=True))), starts, ends, strict=True):
        parts = [x[max(0, lo - first) : max(0, hi - first)] for first, x in blocks]
        out.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
    return out


def _try_each(media: list[bytes | None], read) -> list[tuple[object, str | None]]:
    """(result, error) of ``read([stream])`` for each stream, all together where none is damaged; (None, None) for a null."""
    some = [m for m in media if m is not None]
    try:
        got = iter([(x, None) for x in read(some)])
    except (ValueError, IndexError, struct.error, RecursionError):
        results = []
        for m in some:
            try:
                results.append((read([m])[0], None))
            except (ValueError, IndexError, struct.error, RecursionError) as e:
                results.append((None, f"{type(e).__name__}: {e}"))
        got = iter(results)
    return [(None, None) if m is None else next(got) for m in media]


# --- columns -----------------------------------------------------------------------------------


def payload_of(text: str | None, unit: int = 64) -> bytes:
    """A text as padded bytes: zeros up to a positive multiple of ``unit``."""
    raw = (text or "").encode()
    return raw + b"\0" * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def store_text(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """A media column: each whole text's padded bytes as a FLAC stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            texts = batch.column(1).to_pylist()
            media = encode_streams([payload_of(t) for t in texts])
            n = [len((t or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return anti_clash(docs, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def pcm_blocks(media: DataFrame, id_col="doc_id", media_col="media") -> DataFrame:
    """Decodes a media column into PCM blocks: (id, block, sample_offset, n_samples, pcm, error), seekable by offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 2 << 20):
            rows = []
            for d, (got, error) in zip(batch.column(0).to_pylist(), _try_each(batch.column(1).to_pylist(), decode_streams), strict=True):
                if got is None:
                    rows.append((d, None, None, None, None, error))
                    continue
                s, blocks = got
                rows += [(d, i, first, len(x), pcm_bytes(s, [(first, x)]), None) for i, (first, x) in enumerate(blocks or [(0, np.zeros(0, np.int32))])]
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "block", "sample_offset", "n_samples", "pcm", "error"])

    kind = media.schema[id_col].dataType.simpleString()
    return anti_clash(media, doc_id=id_col, media=media_col).mapInArrow(run, f"doc_id {kind}, block int, sample_offset long, n_samples long, pcm binary, error string")


def feature(x: np.ndarray) -> str:
    """Level features of samples: RMS, peak, sign changes and the mean step, as text."""
    y = x.astype(np.int64)
    n = max(1, len(y))
    steps = int(np.abs(np.diff(y)).sum())
    return f"rms={np.sqrt(int((y * y).sum()) / n):.4f};peak={int(np.abs(y).max()) if len(y) else 0};zcr={int((np.diff(np.signbit(y))).sum()) / n:.6f};step={steps / n:.4f}"


def _digest(media: list[bytes]) -> list[tuple]:
    """Digests of streams: of their PCM blocks in the order of sample offsets, and of the last 64 samples, read by seeking."""
    whole = decode_streams(media)
    ends = [s.total for s, _ in whole]
    tails = read_range(media, [max(0, n - 64) for n in ends], ends)
    out = []
    for m, (s, blocks), tail in zip(media, whole, tails, strict=True):
        raw = (np.frombuffer(pcm_bytes(s, blocks), np.uint8) ^ 0x80).tobytes() if s.bits <= 8 else pcm_bytes(s, blocks)
        x = np.concatenate([b for _, b in blocks]) if blocks else np.zeros(0, np.int32)
        out.append((len(raw), hashlib.sha256(raw).hexdigest(), crc32((tail + 128).astype(np.uint8).tobytes()), len(m), hashlib.sha256(m).hexdigest(), feature(x)))
    return out


def media_digests(media: DataFrame) -> DataFrame:
    """Reads stored media back (``store_text``) and returns digests and features of what it decodes to, or the error."""
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 2 << 20):
            rows = [(*(got or (None,) * 6), error) for got, error in _try_each(batch.column(2).to_pylist(), _digest)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], ["doc_id", "n_bytes", *names, "error"])

    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string")
