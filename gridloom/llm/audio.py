"""Media columns: audio clips stored losslessly, and their features as fixed-shape tensors with time spans.

A clip is a WAV file (mono, 8-bit samples) in a binary column. Features: polyphase resampling to a lower rate, log-mel
energies of overlapped Hann frames, and segments by hysteresis on frame energy (a segment opens above the high threshold and
closes below the low one). Each segment's log-mel frames are averaged to a tensor of fixed shape (steps, mels).

Results for odd inputs: a null payload is empty; an empty payload gives one frame of silence and no segment; rows
with equal ids are kept each; extra columns are ignored; everything depends on the payload alone.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from numpy.lib.stride_tricks import sliding_window_view
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, text_bytes, tune

RATE, UP, DOWN, FRAME, HOP, MELS, STEPS = 16_000, 1, 2, 256, 128, 16, 4


def wav(payload: bytes, rate: int = RATE) -> bytes:
    """A mono 8-bit PCM WAV file of these samples."""
    n, pad = len(payload), len(payload) % 2
    return b"RIFF" + struct.pack("<I", 36 + n + pad) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", n) + payload + b"\0" * pad


def wav_samples(data: bytes) -> tuple[bytes, int]:
    """(samples, rate) of a mono 8-bit PCM WAV file; other chunks are skipped."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(data):
        kind, n = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        if kind == b"fmt ":
            form, channels, rate, _, _, bits = struct.unpack("<HHIIHH", data[at + 8 : at + 24])
            if (form, channels, bits) != (1, 1, 8):
                raise ValueError("only mono 8-bit PCM is read")
        elif kind == b"data":
            return data[at + 8 : at + 8 + n], rate
        at += 8 + n + n % 2
    raise ValueError("a WAV file without samples")


@lru_cache
def _filter(up: int, down: int, half: int = 8) -> np.ndarray:
    """The (up, taps) phases of a Hann-windowed sinc low-pass at the lower of both rates."""
    top = max(up, down)
    t = np.arange(-half * top, half * top + 1)
    h = np.sinc(t / top) * np.hanning(len(t) + 2)[1:-1]
    h *= up / h.sum()
    h = np.concatenate([h, np.zeros(-len(h) % up)])
    return np.ascontiguousarray(h.reshape(-1, up).T[:, ::-1]).astype(np.float32)


def resample(x: np.ndarray, up: int = UP, down: int = DOWN) -> np.ndarray:
    """Rational resampling; each output sample costs one phase of the filter. The filter's delay is taken out."""
    phases = _filter(up, down)
    taps = phases.shape[1]
    delay = 8 * max(up, down)
    n = -(-len(x) * up // down)
    padded = np.concatenate([np.zeros(taps - 1, np.float32), x, np.zeros(taps + delay // up + 1, np.float32)])
    view = sliding_window_view(padded, taps)
    y = np.empty(n, np.float32)
    for r in range(min(up, n)):  # outputs whose place in the up-sampled stream has the same phase
        m = np.arange(r, n, up, dtype=np.int64)
        place = m * down + delay
        y[r::up] = view[place[0] // up :: down][: len(m)] @ phases[(place[0]) % up]
    return y


@lru_cache
def _mel_bank(rate: float, frame: int = FRAME, mels: int = MELS) -> np.ndarray:
    to_mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, to_mel(rate / 2), mels + 2) / 2595) - 1)
    f = np.linspace(0, rate / 2, frame // 2 + 1)[:, None]
    rise, fall = (f - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


_HANN = np.hanning(FRAME + 1)[:-1].astype(np.float32)


def log_mel(y: np.ndarray, rate: float, block: int = 4096) -> np.ndarray:
    """(frames, mels) log energies of half-overlapped frames, in blocks of frames; the last frame is padded with zeros."""
    frames = max(1, -(-(len(y) - FRAME) // HOP) + 1)
    y = np.concatenate([y, np.zeros(max(0, (frames - 1) * HOP + FRAME - len(y)), np.float32)])
    view, bank = sliding_window_view(y, FRAME)[::HOP], _mel_bank(rate)
    out = np.empty((frames, MELS), np.float32)
    for i in range(0, frames, block):
        spectrum = np.fft.rfft(view[i : i + block] * _HANN)
        out[i : i + block] = np.log((spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ bank + 1e-8)
    return out


def segments(energy: np.ndarray, least: int = 4) -> np.ndarray:
    """[first, end) frames of the segments: open at mean + s / 2, closed below mean - s / 2 (s: the standard deviation); shorter ones than `least` go."""
    mean, s = float(energy.mean()), float(energy.std())
    if s < 1e-6:
        return np.zeros((0, 2), np.int64)
    event = np.where(energy >= mean + s / 2, 1, np.where(energy < mean - s / 2, -1, 0))
    last = np.maximum.accumulate(np.where(event != 0, np.arange(len(event)), -1))
    on = np.concatenate([[False], (last >= 0) & (event[np.maximum(last, 0)] > 0), [False]])
    edge = np.flatnonzero(np.diff(on.view(np.int8)))
    found = np.stack([edge[::2], edge[1::2]], 1)
    return found[found[:, 1] - found[:, 0] >= least]


def tensors(mel: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """(segments, STEPS, MELS): means of the frames in equal parts of each segment."""
    total = np.concatenate([np.zeros((1, mel.shape[1])), np.cumsum(mel, 0, dtype=np.float64)])
    cuts = spans[:, :1] + (spans[:, 1:] - spans[:, :1]) * np.arange(STEPS + 1) // STEPS
    lo, hi = cuts[:, :-1], np.maximum(cuts[:, 1:], cuts[:, :-1] + 1)
    return ((total[hi] - total[lo]) / (hi - lo)[..., None]).astype(np.float16)


def media_column(docs: DataFrame, unit: int = 576) -> DataFrame:
    """documents -> doc_id, n_bytes, media: the text's bytes, filled up with 255 to a positive multiple of `unit`, as WAV files in a Parquet column."""
    spark = docs.sparkSession
    tune(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = text_bytes(batch.column(1))
            for i in range(0, len(data), 256):
                part = data[i : i + 256]
                files = [wav(x.tobytes() + b"\xff" * (max(unit, -(-len(x) // unit) * unit) - len(x))) for x in part]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 256), pa.array([len(x) for x in part], pa.int64()), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    path = scratch(spark, "media")
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema("doc_id long, n_bytes long, media binary").parquet(path)


def audio_features(media: DataFrame) -> tuple[DataFrame, str]:
    """media (doc_id, n_bytes, media) -> a digest row per clip, and the folder of the feature files that the tasks write.

    A feature file is Parquet: doc_id, start_s, end_s and the segment's tensor as an Arrow fixed-shape tensor. A row names
    its file; files that no row names are left over from lost tasks.
    """
    spark = media.sparkSession
    tune(spark)
    root = scratch(spark, "audio-features")
    kind = pa.fixed_shape_tensor(pa.float16(), (STEPS, MELS))
    schema = pa.schema([("doc_id", pa.int64()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("tensor", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(root)
        files.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.parquet"
        writer = None
        try:
            for batch in batches:
                rows, doc_of, spans_of, found = [], [], [], []
                for doc, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                    blob = blob.tobytes()
                    payload, rate = wav_samples(blob)
                    y = resample((np.frombuffer(payload, np.uint8).astype(np.float32) - 128) / 128)
                    slow = rate * UP / DOWN
                    mel = log_mel(y, slow)
                    energy = mel.mean(1)
                    spans = segments(energy)
                    t = tensors(mel, spans)
                    doc_of += [doc] * len(spans)
                    spans_of.append(np.stack([spans[:, 0] * HOP, (spans[:, 1] - 1) * HOP + FRAME], 1) / slow)
                    found.append(t)
                    active = float((spans[:, 1] - spans[:, 0]).sum()) / len(mel)
                    bands = ",".join(f"{v:.1f}" for v in mel.reshape(len(mel), 4, -1).mean((0, 2)))
                    feature = f"frames={len(mel)};segments={len(spans)};active={active:.3f};energy={float(energy.mean()):.1f};bands={bands}"
                    rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(blob), hashlib.sha256(blob).hexdigest(), feature, name))
                if doc_of:
                    if writer is None:
                        writer = pq.ParquetWriter(files.open_output_stream(f"{base}/{name}"), schema, compression="zstd")
                    flat = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(found).reshape(-1), pa.float16()), STEPS * MELS)
                    times = np.concatenate(spans_of)
                    writer.write_table(pa.Table.from_arrays([pa.array(doc_of, pa.int64()), pa.array(times[:, 0]), pa.array(times[:, 1]), pa.ExtensionArray.from_storage(kind, flat)], schema=schema))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "file"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 9, kinds)], names=names)
        finally:
            if writer is not None:
                writer.close()

    out = media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, file string")
    return out, root
