"""Media columns: ISO media containers, read by their boxes and sample tables alone.

``inspect`` walks the nested boxes of each value of a binary column, decodes the sample tables and gives codec, duration
and the byte ranges of the key frames; payloads are copied only on request and never decoded. ``wrap`` stores bytes
losslessly as 8-bit samples in such a container.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import numbered, pieces, texts

#: Fixed values of the container format: boxes that hold boxes, and the bytes before the first of those.
NESTED = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"stbl": 0, b"edts": 0, b"dinf": 8, b"udta": 0, b"mvex": 0, b"moof": 0, b"traf": 0}
UNIT, KEY_EVERY, CHUNK, RATE = 64, 16, 32, 8000


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def table(values) -> bytes:
    return np.asarray(values, ">u4").tobytes()


def wrap(payload: bytes) -> bytes:
    """A container with one 8-bit audio track: units of 64 samples, 32 units to a chunk, every 16th unit a key frame."""
    units = len(payload) // UNIT
    chunks = -(-units // CHUNK)
    last = units - CHUNK * (chunks - 1)
    length = units * UNIT
    unity = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    runs = [(1, CHUNK, 1)] if last == CHUNK else ([(1, CHUNK, 1)] if chunks > 1 else []) + [(chunks, last, 1)]
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16))

    def tables(first: int) -> bytes:
        return box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", table([1, units, UNIT])),
            full(b"stss", table([len(range(0, units, KEY_EVERY)), *range(1, units + 1, KEY_EVERY)])),
            full(b"stsc", table([len(runs), *[x for r in runs for x in r]])),
            full(b"stsz", table([UNIT, units])),
            full(b"stco", table([chunks, *(first + CHUNK * UNIT * k for k in range(chunks))])),
        )

    def movie(first: int) -> bytes:
        media = box(
            b"mdia",
            full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, length, 0x55C4, 0)),
            full(b"hdlr", bytes(4), b"soun", bytes(12), b"\x00"),
            box(b"minf", full(b"smhd", bytes(4)), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), tables(first)),
        )
        track = full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, length), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), unity, bytes(8), flags=3)
        head = full(b"mvhd", struct.pack(">IIII", 0, 0, RATE, length), struct.pack(">IH", 0x10000, 0x100), bytes(10), unity, bytes(24), struct.pack(">I", 2))
        return box(b"moov", head, box(b"trak", track, media))

    kind = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"qt  ")
    start = len(kind) + len(movie(0)) + 8
    return kind + movie(start) + box(b"mdat", payload)


def walk(data: memoryview):
    """Every box, outer ones first: its path, and where its body begins and ends. No depth is too deep."""
    todo: list[tuple[int, int, tuple[bytes, ...]]] = [(0, len(data), ())]
    while todo:
        at, end, path = todo.pop()
        if at + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1 and at + 16 <= end:
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise ValueError("a box ends outside its parent")
        yield (*path[-3:], kind), at + head, at + size  # the last names of the path are enough to tell boxes apart
        todo.append((at + size, end, path))
        if kind in NESTED:
            todo.append((at + head + NESTED[kind], at + size, (*path[-3:], kind)))


def numbers(data: memoryview, at: int, n: int, end: int, kind: str = ">u4") -> np.ndarray:
    if at + n * np.dtype(kind).itemsize > end:
        raise ValueError("a table is longer than its box")
    return np.frombuffer(data, kind, n, at).astype(np.int64)


def sample_sizes(data: memoryview, kind: bytes, at: int, end: int) -> np.ndarray:
    """The sizes of ``stsz`` (one for all, or a table) or ``stz2`` (4, 8 or 16 bits each)."""
    one, count = struct.unpack_from(">II", data, at + 4)
    if kind == b"stz2":
        bits = one & 255
        if bits not in (4, 8, 16):
            raise ValueError("a compact size of other than 4, 8 or 16 bits")
        if bits == 4:
            packed = numbers(data, at + 12, -(-count // 2), end, ">u1")
            return np.stack([packed >> 4, packed & 15], 1).ravel()[:count]
        return numbers(data, at + 12, count, end, f">u{bits // 8}")
    if not one:
        return numbers(data, at + 12, count, end)
    if one * count > len(data):
        raise ValueError("more sample bytes than the file has")
    return np.full(count, one, np.int64)


def run_of_samples(data: memoryview, at: int, end: int, base: int, defaults: dict) -> dict:
    """The samples of one ``trun`` box, and where the next run begins."""
    flags, n = struct.unpack_from(">II", data, at)
    flags, at = flags & 0xFFFFFF, at + 8
    if flags & 1:
        base += struct.unpack_from(">i", data, at)[0] - defaults["moved"]
        at += 4
    first = None
    if flags & 4:
        first, at = struct.unpack_from(">I", data, at)[0], at + 4
    fields = [f for f in (0x100, 0x200, 0x400, 0x800) if flags & f]
    if not fields and defaults["size"] * n > len(data) or not fields and not defaults["size"] and n > len(data):
        raise ValueError("more sample bytes than the file has")
    rows = numbers(data, at, n * len(fields), end).reshape(n, len(fields))

    def field(f: int, other: int) -> np.ndarray:
        return rows[:, fields.index(f)] if f in fields else np.full(n, other, np.int64)

    times, sizes, marks = field(0x100, defaults["time"]), field(0x200, defaults["size"]), field(0x400, defaults["flags"])
    if first is not None and n:
        marks = np.concatenate([[first], marks[1:]])
    stops = base + np.cumsum(sizes)
    return {"sizes": sizes, "offsets": stops - sizes, "keys": (marks & 0x10000) == 0, "time": int(times.sum()), "next": int(stops[-1]) if n else base}


def fragment_defaults(data: memoryview, at: int, moof: int, general: dict[int, tuple]) -> tuple[int, int, dict]:
    """Track number, base offset and defaults of one ``tfhd`` box."""
    flags, track = struct.unpack_from(">II", data, at)
    at += 8
    base = moof
    if flags & 1:
        base, at = struct.unpack_from(">Q", data, at)[0], at + 8
    at += 4 if flags & 2 else 0
    values = list(general.get(track, (0, 0, 0)))
    for k, f in enumerate((8, 16, 32)):
        if flags & f:
            values[k], at = struct.unpack_from(">I", data, at)[0], at + 4
    return track, base, dict(zip(("time", "size", "flags"), values), moved=0)


def tracks(data: memoryview) -> list[dict]:
    """Codec, time scale, duration and the offset, size and key flag of each sample, for each track.

    Sample tables come first; samples of movie fragments follow in the order of the file.
    """
    found: list[dict] = []
    general: dict[int, tuple] = {}
    runs: dict[int, list[dict]] = {}
    moof, now, base, defaults = 0, None, 0, {}
    for path, at, end in walk(data):
        kind = path[-1]
        if kind == b"moof":
            moof, now = at - 8, None
        elif kind == b"trex":
            track, _, *values = struct.unpack_from(">5I", data, at + 4)
            general[track] = tuple(values)
        elif kind == b"tfhd":
            now, base, defaults = fragment_defaults(data, at, moof, general)
        elif kind == b"trun" and now is not None:
            got = run_of_samples(data, at, end, base, defaults)
            runs.setdefault(now, []).append(got)
            defaults["moved"] += got["next"] - base  # without an offset of its own a run follows the one before
            base = got["next"]
        elif kind == b"trak":
            found.append({})
        if not found or path[-2:-1] not in ((b"trak",), (b"mdia",), (b"minf",), (b"stbl",)):
            continue
        t = found[-1]
        n = struct.unpack_from(">I", data, at + 4)[0] if kind in (b"stts", b"stss", b"stsc", b"stco", b"co64") else 0
        if kind == b"tkhd":
            t["number"] = struct.unpack_from(">I", data, at + (20 if data[at] == 1 else 12))[0]
        elif kind == b"mdhd":
            long = data[at] == 1
            t["scale"], t["length"] = struct.unpack_from(">IQ" if long else ">II", data, at + (20 if long else 12))
        elif kind == b"hdlr":
            t["kind"] = bytes(data[at + 8 : at + 12]).decode("latin-1")
        elif kind == b"stsd":
            t["codec"] = bytes(data[at + 12 : min(at + 16, end)]).decode("latin-1") or None
        elif kind == b"stts":
            pairs = numbers(data, at + 8, 2 * n, end).reshape(-1, 2)
            t["time"] = sum(a * b for a, b in pairs.tolist())
        elif kind == b"stss":
            t["keys"] = numbers(data, at + 8, n, end) - 1
        elif kind == b"stsc":
            t["runs"] = numbers(data, at + 8, 3 * n, end).reshape(-1, 3)
        elif kind in (b"stsz", b"stz2"):
            t["sizes"] = sample_sizes(data, kind, at, end)
        elif kind in (b"stco", b"co64"):
            t["chunks"] = numbers(data, at + 8, n, end, ">u4" if kind == b"stco" else ">u8")
    for t in found:
        place(t, runs.get(t.get("number"), []), len(data))
    return found


def place(t: dict, fragments: list[dict], length: int) -> None:
    """The offsets of a track's samples from its tables, then those of its fragments; none may lie outside the file."""
    none = np.zeros(0, np.int64)
    sizes, chunks, runs = t.get("sizes", none), t.get("chunks", none), t.get("runs", none.reshape(0, 3))
    spans = np.diff(np.append(runs[:, 0], len(chunks) + 1))
    if len(runs) and (runs[0, 0] != 1 or (spans < 1).any()):
        raise ValueError("chunk runs out of order")
    upto = np.cumsum(np.minimum(np.repeat(runs[:, 1], spans), len(sizes)))
    if len(sizes) > (upto[-1] if len(upto) else 0):
        raise ValueError("samples without a place")
    in_chunk = np.searchsorted(upto, np.arange(len(sizes)), side="right")
    before = np.cumsum(sizes) - sizes
    first = np.concatenate([[0], upto])[in_chunk]
    offsets = chunks[in_chunk] + before - before[first] if len(sizes) else none
    keys = t.get("keys", np.arange(len(sizes)))
    if len(keys) and (keys.min() < 0 or keys.max() >= len(sizes)):
        raise ValueError("a key frame that is no sample")
    for f in fragments:
        keys = np.concatenate([keys, len(sizes) + np.flatnonzero(f["keys"])])
        sizes, offsets = np.concatenate([sizes, f["sizes"]]), np.concatenate([offsets, f["offsets"]])
        t["time"] = t.get("time", 0) + f["time"]
    if len(sizes) and (offsets.min() < 0 or (offsets > length - sizes).any()):
        raise ValueError("a sample outside the file")
    t.update(sizes=sizes, offsets=offsets, keys=keys)


def described(data: bytes) -> dict:
    """One container's features; ``error`` says what is wrong with bytes that are none."""
    try:
        got = tracks(memoryview(data))
        if not got:
            raise ValueError("no track")
        t = got[0]
        duration = 1000 * t.get("time", 0) // max(1, t.get("scale", 1))
        if duration >= 1 << 63:
            raise ValueError("a duration beyond 63 bits")
        starts = t["offsets"][t["keys"]]
        ranges = ",".join(f"{a}-{b}" for a, b in zip(starts.tolist(), (starts + t["sizes"][t["keys"]]).tolist()))
        return {"codec": t.get("codec"), "duration_ms": duration, "n_samples": len(t["sizes"]), "key_ranges": ranges, "track": t, "error": None}
    except (ValueError, IndexError, OverflowError, struct.error) as e:
        return {"codec": None, "duration_ms": None, "n_samples": 0, "key_ranges": "", "track": None, "error": str(e)}


def payload(data: bytes, track: dict | None) -> bytes:
    """The samples' bytes in order, as the tables place them; runs that lie together are copied at once."""
    if track is None or not len(track["sizes"]):
        return b""
    offsets, sizes = track["offsets"], track["sizes"]
    cut = np.flatnonzero(offsets[1:] != offsets[:-1] + sizes[:-1]) + 1
    starts, stops = offsets[np.append(0, cut)], (offsets + sizes)[np.append(cut - 1, len(sizes) - 1)]
    return b"".join(data[a:b] for a, b in zip(starts.tolist(), stops.tolist()))


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media``: each whole text, zero-filled to a multiple of 64 bytes, in a container.

    A null or empty text has 0 bytes and 64 zeros in its container; a null id stays null; repeated rows give repeated
    rows and equal texts equal containers; other columns, whatever their names, aren't read. A long text is one piece.
    """

    def run(batches):
        for b in pieces(batches, 4 << 20):
            own = [x.encode("utf-8") for x in texts(b)]
            held = [wrap(x + bytes(-len(x) % UNIT or (0 if x else UNIT))) for x in own]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(list(map(len, own)), pa.int64()), pa.array(held, pa.binary())], ["doc_id", "n_bytes", "media"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def inspect(media: DataFrame, media_col: str = "media", with_payload: bool = False) -> DataFrame:
    """The columns of ``media`` but the container itself, and codec, duration_ms, n_samples, key_ranges and error.

    ``with_payload`` adds payload_bytes, payload_sha256 and tail_crc32 (last 64 bytes) of the samples as stored, and
    media_bytes and media_sha256 of the container. A null or broken container has null codec and an error, and no
    samples; so has one whose tables don't fit their boxes or place a sample outside the file. New columns take the
    place of columns of the same name; other columns may have any name. Repeated rows give repeated rows.
    """
    new = "codec string, duration_ms long, n_samples long, key_ranges string, error string"
    if with_payload:
        new += ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"
    names = [x.split(" ")[0] for x in new.split(", ")]
    kept = [c for c in media.columns if c not in names and c != media_col]
    schema = numbered(media.select(*[F.col(f"`{c}`") for c in kept]))[1]
    held = "media_value"
    chosen = media.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{media_col}`").alias(held))
    schema = ", ".join([x for x in (schema, new) if x])
    carried = [f"c{i}" for i in range(len(kept))]

    def run(batches):
        for b in pieces(batches, 8 << 20, held):
            rows: dict[str, list] = {n: [] for n in names}
            for i in range(b.num_rows):
                data = b.column(held)[i].as_py() or b""
                got = described(data)
                if with_payload:
                    own = payload(data, got["track"])
                    got |= {"payload_bytes": len(own), "payload_sha256": hashlib.sha256(own).hexdigest(), "tail_crc32": zlib.crc32(own[-UNIT:]), "media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest()}
                for n in names:
                    rows[n].append(got[n])
            kinds = {n: pa.string() if n in ("codec", "key_ranges", "error", "payload_sha256", "media_sha256") else pa.int64() for n in names}
            yield pa.RecordBatch.from_arrays([b.column(c) for c in carried] + [pa.array(rows[n], kinds[n]) for n in names], carried + names)

    return chosen.mapInArrow(run, schema).toDF(*kept, *names)
