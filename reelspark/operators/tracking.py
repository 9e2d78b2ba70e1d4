"""Greedy face tracking: a sequential rule, applied between the places where no track can go on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.operators.segmented import group_numbers

#: Overlap a face needs with the track's last one, and frames a track may miss.
MIN_IOU, MAX_GAP = 0.5, 10


def _overlaps(boxes: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Overlap of each of ``boxes`` with ``box``."""
    sides = np.maximum(np.minimum(boxes[:, 2:], box[2:]) - np.maximum(boxes[:, :2], box[:2]), 0)
    shared, sizes = sides[:, 0] * sides[:, 1], (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])
    return shared / (sizes + (box[2] - box[0]) * (box[3] - box[1]) - shared + 1e-5)


def tracks_of(faces: list[tuple], min_length: int, same_frame: bool, skipping: bool = False) -> Iterator[tuple[int, int]]:
    """(place of the face, track) for ``faces`` (frame, face_no, box) in the order of frames.

    The first free face starts a track; each later free face within ``MAX_GAP`` frames of its end
    that overlaps the end enough is added; the first beyond closes it. Tracks shorter than
    ``min_length`` are not returned, but their faces are used up. ``same_frame``: whether a face
    in the frame of the track's end may be added. ``skipping``: whether the face after one that is taken, in
    the same frame, is passed over for this track, as in a loop over a list from which what it takes is removed.

    For the track's end, overlaps with the free faces of the next ``MAX_GAP`` frames are worked out together.
    """
    frames, boxes = np.array([f[0] for f in faces]), np.array([f[2] for f in faces], float).reshape(-1, 4)
    free, number = np.arange(len(frames)), 0
    while len(free):
        taken, at, when = [0], 0, frames[free]
        while at < len(free):
            end = free[taken[-1]]
            upto = int(np.searchsorted(when, frames[end] + MAX_GAP, side="right"))
            ahead = free[at + 1 : upto]
            fits = _overlaps(boxes[ahead], boxes[end]) > MIN_IOU
            if not same_frame:
                fits &= frames[ahead] > frames[end]
            if skipping and len(ahead) and frames[ahead[0]] == frames[free[at]]:
                fits[0] = False
            hits = np.flatnonzero(fits)
            if not len(hits):
                break
            at += 1 + int(hits[0])
            taken.append(at)
        track = free[taken]
        free = np.delete(free, taken)
        if len(track) >= min_length:
            for k in track.tolist():
                yield k, number
            number += 1


def greedy_tracks(faces: DataFrame, keys: list[str], min_length: int, same_frame: bool = False, skipping: bool = False) -> DataFrame:
    """keys, frame, face_no, track: faces (keys, frame, face_no, x1, y1, x2, y2) that belong to a track; tracks of a key are numbered from 0.

    A track never reaches over more than ``MAX_GAP`` frames without a face. There the faces of a key are cut, for series of any
    length, and what is between two cuts is one group; so a group is as long as faces follow one another, not as the clip.
    With ``same_frame`` and ``skipping`` faces are taken as by a loop that removes them from the list it goes over.
    """
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in faces.schema.fields if f.name in keys)
    cut = group_numbers(faces.select(*keys, "frame", "face_no", "x1", "y1", "x2", "y2"), keys, "frame", MAX_GAP, "part")

    def follow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["frame", "face_no"], kind="stable").reset_index(drop=True)
        rows = list(zip(part["frame"], part["face_no"], part[["x1", "y1", "x2", "y2"]].to_numpy(float), strict=True))
        found = list(tracks_of(rows, min_length, same_frame, skipping))
        out = part.iloc[[k for k, _ in found]][[*keys, "part", "frame", "face_no"]].copy()
        out["track"] = [t for _, t in found]
        return out

    found = cut.groupBy(*keys, "part").applyInPandas(follow, f"{key_schema}, part long, frame long, face_no long, track long")
    found = scratch.written(found, "tracks")
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = found.groupBy(*keys, "part").agg((F.max("track") + 1).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return found.join(before, [*keys, "part"]).select(*keys, "frame", "face_no", (F.col("track") + F.col("before")).alias("track"))
