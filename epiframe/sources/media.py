"""Video frames through an injected decoder: samples, labels on them, and histograms. No decoder is bundled, and of encoders only PNG's."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FrameSample:
    camera_key: str
    frame_index: int
    timestamp_seconds: float
    jpeg: bytes


#: path to the decoded frames in order, as arrays of height x width x 3 bytes
Decoder = Callable[[str], Iterable[np.ndarray]]
Encoder = Callable[[np.ndarray, str], bytes]


def extract_frames(path: str, camera: str, indices: list[int], fps: float, decode: Decoder, encode: Encoder) -> list[FrameSample]:
    """The wanted frames in order, decoded once, up to the last of them and no further; missing ones are an error."""
    if not indices or any(type(i) is not int or i < 0 for i in indices) or sorted(set(indices)) != list(indices):
        raise ValueError("increasing frame numbers are needed")
    if not (math.isfinite(fps) and fps > 0):
        raise ValueError("fps must be positive")
    wanted, out = set(indices), []
    frames = iter(decode(path))
    try:
        for i, frame in enumerate(frames):
            if i in wanted:
                out.append(FrameSample(camera, i, i / fps, encode(frame, f"{camera} {i} {i / fps:.3f}s")))
                if i == indices[-1]:
                    break
    finally:
        if hasattr(frames, "close"):
            frames.close()
    if len(out) != len(indices):
        raise ValueError(f"frames missing: {sorted(wanted - {s.frame_index for s in out})}")
    return out


# A font of 3 by 5 dots, a digit of 3 bits for each row from the top.
FONT = {
    "A": "25755", "B": "65656", "C": "34443", "D": "65556", "E": "74647", "F": "74644", "G": "34553", "H": "55755", "I": "72227", "J": "11152", "K": "55655", "L": "44447", "M": "57755",
    "N": "57775", "O": "25552", "P": "65644", "Q": "25563", "R": "65655", "S": "34216", "T": "72222", "U": "55557", "V": "55522", "W": "55775", "X": "55255", "Y": "55222", "Z": "71247",
    "0": "75557", "1": "26227", "2": "71747", "3": "71717", "4": "55711", "5": "74717", "6": "74757", "7": "71111", "8": "75757", "9": "75717", ".": "00002", "_": "00007", "-": "00700", "/": "11244",
}


def labelled(frame: np.ndarray, label: str, scale: int = 2) -> np.ndarray:
    """A copy of the frame with a label in white on black in its upper left corner, as much of it as fits; unknown characters are blanks."""
    out = np.array(frame, np.uint8)
    rows = np.zeros((7, 4 * len(label) + 1), np.uint8)
    for i, c in enumerate(label.upper()):
        for y, bits in enumerate(FONT.get(c, "00000")):
            rows[y + 1, 4 * i + 1 : 4 * i + 4] = [int(bits) >> 2 & 1, int(bits) >> 1 & 1, int(bits) & 1]
    dots = np.kron(rows, np.ones((scale, scale), np.uint8))[: out.shape[0], : out.shape[1]]
    out[: dots.shape[0], : dots.shape[1]] = dots[:, :, None] * 255
    return out


def png(frame: np.ndarray) -> bytes:
    """An image of height x width x 3 bytes as a PNG file."""
    height, width, _ = frame.shape

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    lines = np.concatenate([np.zeros((height, 1), np.uint8), np.ascontiguousarray(frame, np.uint8).reshape(height, width * 3)], axis=1)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def encode_png(frame: np.ndarray, label: str) -> bytes:
    """The Encoder for those who bring none."""
    return png(labelled(frame, label))


def encode_jpeg(frame: np.ndarray, label: str, quality: int = 90) -> bytes:
    """The Encoder where Pillow is installed."""
    import io

    from PIL import Image

    out = io.BytesIO()
    Image.fromarray(labelled(frame, label)).save(out, "JPEG", quality=quality)
    return out.getvalue()


def check_samples(samples: list[FrameSample], indices: list[int], camera: str, fps: float) -> None:
    """That samples are what was asked for."""
    if [s.frame_index for s in samples] != list(indices) or any(s.camera_key != camera or not s.jpeg or abs(s.timestamp_seconds - s.frame_index / fps) > 1e-7 for s in samples):
        raise ValueError("the samples are not those asked for")


def video_histograms(videos: DataFrame, decode: Decoder) -> DataFrame:
    """(camera, channel, bin, n) of a table (camera, path, frames, height, width): 3 x 256 counts for each video, made in the tasks.

    Add them up by ``statistics.histogram_stats`` after a groupBy; wrong shapes, types or frame counts are errors.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for r in p.itertuples(index=False):
                counts, seen = np.zeros((3, 256), np.int64), 0
                for frame in decode(r.path):
                    if frame.dtype != np.uint8 or frame.shape != (r.height, r.width, 3):
                        raise ValueError(f"{r.path}: a frame of {frame.dtype} {frame.shape}")
                    counts += [np.bincount(frame[..., c].ravel(), minlength=256) for c in range(3)]
                    seen += 1
                if seen != r.frames:
                    raise ValueError(f"{r.path}: {seen} frames, expected {r.frames}")
                c, b = np.nonzero(counts)
                yield pd.DataFrame({"camera": r.camera, "channel": c.astype(np.int32), "bin": b.astype(np.int32), "n": counts[c, b]})

    return videos.mapInPandas(run, "camera string, channel int, bin int, n long")
