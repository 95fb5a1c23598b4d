"""Operator 8: media columns. Payloads as 8-bit WAV samples, and spectral-peak pair fingerprints.

A payload is written by the wave module as one channel of unsigned 8-bit
samples, read back by it, cut into windows that overlap by half and Fourier-transformed.
Peaks are local maxima of the spectrum in time and frequency; each is paired
with those of the next FAN peaks that come later within a target zone, and a pair gives a
landmark (time, code) with code = frequency 1, frequency 2, time difference.
Times count half windows; a code has the difference in whole windows in its
lowest byte and bit 24 for another half.

Edge cases: a null text is empty, its payload is 64 zero bytes; half a window
of silence before the payload and silence up to a whole frame after it, for the
transform only, put every byte into two windows whose weights add up to about one; equal
payloads give equal values; repeated rows give repeated rows; long payloads are
transformed whole, block by block; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import map_rows, text_bytes

UNIT = 64
RATE = 8000
WINDOW, HOP = 256, 128
#: Frames transformed at once; this bounds memory.
BLOCK = 4096
#: Frames ahead that a peak is paired with, and how many of the peaks that follow it at most.
REACH, FAN = 8 * WINDOW // HOP, 5
#: Bins from which a window's peak is taken, one for each band.
BANDS = (2, 12, 40, 129)


def pad(payload: bytes) -> bytes:
    """payload with zero bytes up to a positive multiple of UNIT."""
    return payload + b"\0" * (-len(payload) % UNIT or UNIT * (not payload))


def write_wav(samples: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(samples)
    return out.getvalue()


def read_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes())


def spectral_peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(frame, bin) of the strongest bin of each band that exceeds the frame's mean and both neighbouring frames.

    Frame i begins at sample HOP * i; the first is frame -1.
    """
    x = np.full(HOP * (-(-len(samples) // HOP) + 2), 128, np.uint8)
    x[HOP : HOP + len(samples)] = np.frombuffer(samples, np.uint8)
    frames = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[::HOP]
    taper = np.hanning(WINDOW).astype(np.float32)
    best, level, mean = [], [], []
    for i in range(0, len(frames), BLOCK):
        f = (frames[i : i + BLOCK].astype(np.float32) - 128) * taper
        power = np.abs(np.fft.rfft(f, axis=1)).astype(np.float32)
        tops = [power[:, a:b].argmax(1) + a for a, b in zip(BANDS, BANDS[1:])]
        best.append(np.stack(tops, 1))
        level.append(np.stack([power[np.arange(len(f)), t] for t in tops], 1))
        mean.append(power[:, BANDS[0] :].mean(1))
    best, level, mean = np.concatenate(best), np.concatenate(level), np.concatenate(mean)
    edge = np.zeros((1, level.shape[1]), np.float32)
    before, after = np.vstack([edge, level[:-1]]), np.vstack([level[1:], edge])
    frame, band = np.nonzero((level > 2 * mean[:, None]) & (level >= before) & (level > after))
    return frame - 1, best[frame, band]


def landmarks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(time, code) of the pairs of peaks, by time and then code."""
    frame, tone = spectral_peaks(samples)
    times, codes = [], []
    for step in range(1, FAN + 1):
        gap = frame[step:] - frame[:-step]
        ok = (gap > 0) & (gap <= REACH)
        times.append(frame[:-step][ok])
        whole, half = np.divmod(gap[ok] * HOP, WINDOW)
        codes.append(((half > 0) << 24) | (tone[:-step][ok] << 16) | (tone[step:][ok] << 8) | whole)
    t, c = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


def media_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """One row per row of df: the stored form with digests, and the fingerprint as time-coded arrays.

    keep leaves the stored bytes and the arrays in; `feature` digests the arrays.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "times", "codes", "media")
        for batch in batches:
            out = {id_col: batch.column(0)} | {n: [] for n in names}
            for text in batch.column(1):
                raw = text.as_py()
                media = write_wav(pad(raw))
                back = read_wav(media)
                times, codes = landmarks(back)
                digest = hashlib.sha256(times.tobytes() + codes.tobytes()).hexdigest()
                row = (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), f"{len(times)}:{digest}")
                for n, v in zip(names, row + (times, codes, media) if keep else row):
                    out[n].append(v)
            if keep:
                out |= {n: pa.array(out[n], pa.list_(pa.int32())) for n in ("times", "codes")}
            yield out

    more = ", times array<int>, codes array<int>, media binary" if keep else ""
    schema = (
        f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string{more}"
    )
    return map_rows(df.select(F.col(id_col), text_bytes(text_col)), run, schema)
