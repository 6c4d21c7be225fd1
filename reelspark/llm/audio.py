"""Media columns: audio with features.

A media column holds WAV files of 8-bit samples. Features come out of the stored bytes:
samples are resampled by a polyphase filter (only the taps of the phase that an output
sample needs), cut into overlapped windows, and turned into log-mel filterbanks.
Frames are loud or not by hysteresis: a stretch begins where the energy reaches the upper
threshold and lasts until it falls under the lower one. The filterbanks are stored as
fixed-shape Arrow tensors (an Arrow stream in a binary column, with the time span of each
tensor), the stretches as time spans.

A signal goes through in blocks of BLOCK_FRAMES frames, so that beside the file itself
only a few numbers a frame are in memory, whatever its length.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import released, slices, text_of

#: Payload bytes are padded with zeros to a positive multiple of this.
UNIT = 64
BATCH_BYTES = 1 << 22
BLOCK_FRAMES = 1 << 12


@dataclass(frozen=True)
class Settings:
    """How a signal is looked at; times in samples of the resampled signal."""

    stored_rate: int = 24_000
    rate: int = 16_000
    taps: int = 12  # of each phase
    window: int = 400
    hop: int = 160
    fft: int = 512
    bands: int = 40
    tensor_frames: int = 100
    on_db: float = 6.0  # over the quiet frames' level
    off_db: float = 3.0
    quiet: float = 0.1  # the quantile of frames that is the quiet level

    def seconds_to_ms(self, samples: int) -> int:
        return samples * 1000 // self.rate


def to_wav(payload: bytes, rate: int) -> bytes:
    """A WAV file of one channel of 8-bit samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(rate)
        f.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> tuple[bytes, int]:
    """The 8-bit samples of a WAV file and their rate; another width or more channels raise ValueError."""
    with wave.open(io.BytesIO(media)) as f:
        if f.getsampwidth() != 1 or f.getnchannels() != 1:
            raise ValueError("not one channel of 8-bit samples")
        return f.readframes(f.getnframes()), f.getframerate()


class Resampler:
    """Rational resampling by up / down: output n is the sum of taps of phase n * down % up over inputs around n * down / up."""

    def __init__(self, source: int, target: int, taps: int):
        step = np.gcd(source, target)
        self.up, self.down, self.taps = int(target // step), int(source // step), taps
        n = self.up * taps
        # a windowed sinc, cut off at the lower of both Nyquist rates; each phase sums to one
        at = (np.arange(n) - n // 2) / max(self.up, self.down)
        self.phases = (np.sinc(at) * np.hanning(n + 1)[:-1]).reshape(taps, self.up).T[:, ::-1].copy()
        self.phases /= self.phases.sum(axis=1, keepdims=True)

    def length(self, samples: int) -> int:
        return -(-samples * self.up // self.down)

    def run(self, samples: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Outputs start to stop of uint8 samples (as -1 to 1), which are zero outside."""
        reach = self.taps // 2
        first = start * self.down // self.up - (self.taps - 1 - reach)
        last = (stop - 1) * self.down // self.up + reach + 1
        own = (samples[max(0, first) : max(0, min(last, len(samples)))].astype(np.float32) - 128) / 128
        own = np.pad(own, (max(0, -first), max(0, last - max(len(samples), first))))
        views = np.lib.stride_tricks.sliding_window_view(own, self.taps)
        out = np.empty(stop - start)
        for i in range(min(self.up, stop - start)):  # outputs of one phase are a strided view of the inputs
            n = start + i
            at = n * self.down // self.up - start * self.down // self.up
            count = -(-(stop - n) // self.up)
            out[i :: self.up] = views[at :: self.down][:count] @ self.phases[n * self.down % self.up].astype(np.float32)
        return out


def mel_bank(rate: int, fft: int, bands: int) -> np.ndarray:
    """Triangular filters, evenly spaced on the mel scale, over the bins of a spectrum: (bins, bands)."""
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, bands + 2) / 2595) - 1)
    bins = np.arange(fft // 2 + 1) * rate / fft
    rise = (bins[:, None] - edges[None, :-2]) / np.diff(edges)[None, :-1]
    fall = (edges[None, 2:] - bins[:, None]) / np.diff(edges)[None, 1:]
    return np.maximum(0, np.minimum(rise, fall))


def hysteresis(energy: np.ndarray, on: float, off: float) -> np.ndarray:
    """(stretches, 2) of frames [start, stop): from energy >= on until energy < off."""
    if not len(energy):
        return np.zeros((0, 2), np.int64)
    says = np.where(energy >= on, 1, np.where(energy < off, 0, -1))
    last = np.maximum.accumulate(np.where(says >= 0, np.arange(len(says)), -1))  # the last frame that says anything
    loud = np.where(last >= 0, says[np.maximum(last, 0)], 0)
    edges = np.diff(loud, prepend=0, append=0)
    return np.stack([np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)], axis=1)


class Analyser:
    """Features of signals, with the tables that they share."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.window = np.hanning(settings.window + 1)[:-1]
        self.bank = mel_bank(settings.rate, settings.fft, settings.bands)
        self.resamplers: dict[int, Resampler] = {}
        self.type = pa.fixed_shape_tensor(pa.float32(), (settings.tensor_frames, settings.bands))

    def blocks(self, samples: np.ndarray, rate: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first frame, log-mel, energy) of each block; a signal has a frame for each begun hop, the last ones over silence."""
        if rate not in self.resamplers:
            self.resamplers[rate] = Resampler(rate, self.s.rate, self.s.taps)
        resampler = self.resamplers[rate]
        frames = -(-resampler.length(len(samples)) // self.s.hop)
        for first in range(0, frames, BLOCK_FRAMES):
            count = min(BLOCK_FRAMES, frames - first)
            start = first * self.s.hop
            signal = resampler.run(samples, start, start + (count - 1) * self.s.hop + self.s.window)
            cut = np.lib.stride_tricks.sliding_window_view(signal, self.s.window)[:: self.s.hop][:count]
            cut = cut - cut.mean(axis=1, keepdims=True)
            power = np.abs(np.fft.rfft(cut * self.window, self.s.fft)) ** 2
            yield first, np.log(power @ self.bank + 1e-10), 10 * np.log10(power.sum(axis=1) + 1e-10)

    def stored(self, payload: bytes, rate: int) -> tuple[bytes, int, list[dict], int, np.ndarray]:
        """(tensors, frames, stretches, milliseconds, mean of each band)."""
        s, samples = self.s, np.frombuffer(payload, np.uint8)
        out, energies, sums, kept = io.BytesIO(), [], np.zeros(s.bands), np.zeros((0, s.bands), np.float32)
        total, length = 0, self.s.seconds_to_ms
        schema = pa.schema([("tensor", self.type), ("start_ms", pa.int64()), ("stop_ms", pa.int64()), ("frames", pa.int32())])
        with pa.ipc.new_stream(out, schema) as stream:
            for first, mel, energy in self.blocks(samples, rate):
                sums += mel.sum(axis=0)
                energies.append(energy)
                kept = np.concatenate([kept, mel.astype(np.float32)])
                total = first + len(mel)
                ready = len(kept) // s.tensor_frames
                if ready:
                    stream.write_batch(self._tensors(kept[: ready * s.tensor_frames], total - len(kept), schema))
                    kept = kept[ready * s.tensor_frames :]
            if len(kept):
                stream.write_batch(self._tensors(kept, total - len(kept), schema))
        energy = np.concatenate(energies) if energies else np.zeros(0)
        level = np.partition(energy, k := int(s.quiet * (len(energy) - 1)))[k] if len(energy) else 0.0
        spans = [{"start_ms": length(int(a) * s.hop), "stop_ms": length(int(b) * s.hop)} for a, b in hysteresis(energy, level + s.on_db, level + s.off_db)]
        return out.getvalue(), total, spans, length(total * s.hop), sums / max(1, total)

    def _tensors(self, mel: np.ndarray, first: int, schema: pa.Schema) -> pa.RecordBatch:
        """Frames cut into tensors of one shape, the last one filled up with zeros; frames says how many are real."""
        s = self.s
        count = -(-len(mel) // s.tensor_frames)
        filled = np.zeros((count * s.tensor_frames, s.bands), np.float32)
        filled[: len(mel)] = mel
        starts = first + np.arange(count) * s.tensor_frames
        real = np.minimum(s.tensor_frames, first + len(mel) - starts)
        times = [pa.array([s.seconds_to_ms(int(x) * s.hop) for x in at], pa.int64()) for at in (starts, starts + real)]
        tensor = pa.FixedShapeTensorArray.from_numpy_ndarray(filled.reshape(count, s.tensor_frames, s.bands))
        return pa.RecordBatch.from_arrays([tensor, *times, pa.array(real, pa.int32())], schema=schema)


def tensors(stored: bytes) -> pa.Table:
    """(tensor, start_ms, stop_ms, frames) of a stored row; column tensor is of the fixed-shape tensor type."""
    return pa.ipc.open_stream(stored).read_all()


def text_payload(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, payload): whole texts as UTF-8 (null: empty), with zeros up to a positive multiple of UNIT."""
    data = F.encode(text_of(text_col), "UTF-8")
    n = F.octet_length(data)
    size = F.greatest(F.ceil(n / F.lit(UNIT)) * UNIT, F.lit(UNIT)).cast("int")
    return df.select(df[id_col].alias(id_col), n.cast("long").alias("n_bytes"), F.rpad(data, size, F.lit(b"\x00")).alias("payload"))


def encode(df: DataFrame, *, settings: Settings = Settings()) -> DataFrame:
    """df with its binary column payload stored as a WAV file in column media; a null payload is a null file."""
    at, fields = df.columns.index("payload"), [c for c in df.columns if c != "payload"]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, at, BATCH_BYTES):
            media = [None if x is None else to_wav(x, settings.stored_rate) for x in rows.column(at).to_pylist()]
            yield pa.record_batch([*[rows.column(rows.schema.get_field_index(c)) for c in fields], pa.array(media, pa.binary())], [*fields, "media"])

    return df.mapInArrow(released(run), f"{kinds}, media binary")


_FEATURES = "tensors binary, n_frames long, duration_ms long, segments array<struct<start_ms:long,stop_ms:long>>, mean_log_mel array<float>"
_STORED = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"


def features(df: DataFrame, *, settings: Settings = Settings()) -> DataFrame:
    """df (with a binary column media) without media, and with what is read back of its files.

    tensors: log-mel filterbanks as fixed-shape Arrow tensors (see tensors()); segments: loud
    stretches; payload_bytes, payload_sha256 and tail_crc32 (of the last UNIT bytes)
    of the samples, media_bytes and media_sha256 of the file. Equal files have equal
    values. A null file has nulls, a file without samples no frames; broken files raise.
    Rows may repeat, other columns are kept, and an empty table gives no rows.
    """
    at, fields = df.columns.index("media"), [c for c in df.columns if c != "media"]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in fields)
    span = pa.list_(pa.struct([("start_ms", pa.int64()), ("stop_ms", pa.int64())]))
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), span, pa.list_(pa.float32())]
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "tensors", "n_frames", "duration_ms", "segments", "mean_log_mel"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        analyser = Analyser(settings)
        for rows in slices(batches, at, BATCH_BYTES):
            found = []
            for media in rows.column(at).to_pylist():
                if media is None:
                    found.append([None] * len(names))
                    continue
                payload, rate = from_wav(media)
                stored, frames, spans, ms, mean = analyser.stored(payload, rate)
                found.append([len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), stored, frames, ms, spans, mean.astype(np.float32)])
            columns = zip(*found) if found else [[]] * len(names)
            yield pa.record_batch([*[rows.column(rows.schema.get_field_index(c)) for c in fields], *[pa.array(c, t) for c, t in zip(columns, types)]], [*fields, *names])

    return df.mapInArrow(released(run), f"{kinds}, {_STORED}, {_FEATURES}")


def digests(found: DataFrame) -> DataFrame:
    """found with its features as one string: frames, loud stretches and the mean of all bands, rounded."""
    mean = F.aggregate("mean_log_mel", F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size("mean_log_mel")
    loud = F.aggregate("segments", F.lit(0).cast("long"), lambda a, x: a + x["stop_ms"] - x["start_ms"])
    told = F.concat_ws(";", F.concat(F.lit("frames="), "n_frames"), F.concat(F.lit("ms="), "duration_ms"), F.concat(F.lit("segments="), F.size("segments")), F.concat(F.lit("loud_ms="), loud), F.concat(F.lit("mean="), F.format_number(mean, 2)))
    return found.select(*[c for c in found.columns if c not in ("tensors", "n_frames", "duration_ms", "segments", "mean_log_mel")], told.alias("feature"))
