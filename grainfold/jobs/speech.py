"""Voice activity: labelled frames and their spectra."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainfold.operators import lookup, sequence, signals


def check_pairs(audio: DataFrame, segments: DataFrame) -> DataFrame:
    """Files with and without their counterpart; both tables have a ``stem`` column."""
    return lookup.pair_check(audio, segments, "stem")


def labelled_examples(
    samples: DataFrame, segments: DataFrame, rate: float, nperseg: int = 256, width: int = 3, noise_seed: int | None = None,
) -> DataFrame:
    """(file_id, example, power, label): ``width`` spectra side by side, 1 if mostly speech.

    ``samples`` is (file_id, i, x); ``segments`` is (file_id, start, end) in seconds.
    """
    if noise_seed is not None:
        samples = signals.add_noise(samples, "x", rate, noise_seed, "file_id", "i")
    frames = signals.stft_power(samples, "file_id", "i", "x", nperseg)
    examples = signals.group_frames(frames, "file_id", width)
    step = width * (nperseg // 2)
    whole = samples.groupBy("file_id").agg(F.lit(0).alias("start"), (F.max("i") + 1).alias("end"))
    inside = segments.select("file_id", F.round(F.col("start") * rate).alias("start"), F.round(F.col("end") * rate).alias("end"))
    labels = sequence.label_frames(whole, inside, step, "file_id")
    return examples.join(
        labels.select("file_id", F.col("frame").alias("example"), "label"), ["file_id", "example"]
    )


def raw_examples(samples: DataFrame, segments: DataFrame, rate: float, seconds: float = 0.02) -> DataFrame:
    """(file_id, frame, samples, label): plain frames of ``seconds``, 1 if mostly speech."""
    width = int(seconds * rate)
    frames = signals.cut_frames(samples, "file_id", "i", "x", width)
    whole = samples.groupBy("file_id").agg(F.lit(0).alias("start"), (F.max("i") + 1).alias("end"))
    inside = segments.select("file_id", F.round(F.col("start") * rate).alias("start"), F.round(F.col("end") * rate).alias("end"))
    labels = sequence.label_frames(whole, inside, width, "file_id").select("file_id", "frame", "label")
    return frames.join(labels, ["file_id", "frame"])
