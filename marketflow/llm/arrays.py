"""Sorted hash arrays in a folder all executors mount, written by tasks and memory-mapped by others."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def shared_folder(path: str) -> str:
    """A folder as tasks open it; memory maps need one that is mounted on every executor."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path or not path.startswith("/"):
        raise ValueError(f"{path} is not a mounted folder; give one that all executors mount")
    os.makedirs(path, exist_ok=True)
    return path


def stored(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Write arrays so that a file is there whole or not at all, whichever attempt ends first."""
    for part, array in enumerate(arrays):
        path = f"{folder}/{name}.{part}.npy"
        draft = f"{path}.{uuid.uuid4().hex}"
        with open(draft, "wb") as file:
            np.save(file, array)
        os.replace(draft, path)


def found(folder: str, kind: str, buckets: np.ndarray, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
    """Per bucket: which keys are in its stored array, where they are, and its path."""
    order = np.lexsort((keys, buckets))
    ranked = buckets[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(keys) else np.empty(0, int)
    for a, b in zip(starts, np.append(starts[1:], len(order))):
        path = f"{folder}/{kind}-{ranked[a]}"
        if not os.path.exists(f"{path}.0.npy"):
            continue
        known = np.load(f"{path}.0.npy", mmap_mode="r")
        if not len(known):
            continue
        asked = order[a:b]
        at = np.minimum(np.searchsorted(known, keys[asked]), len(known) - 1)
        hit = known[at] == keys[asked]
        yield asked[hit], at[hit], path


def rows_by_bucket(batches: Iterator[pa.RecordBatch], bucket: int = 0, data: int = 1) -> Iterator[tuple[int, list]]:
    """Sorted rows of a bucket's number and packed data, gathered by bucket."""
    number, held = None, []
    for batch in batches:
        for b, packed in zip(batch.column(bucket).to_pylist(), batch.column(data)):
            if b != number and held:
                yield number, held
                held = []
            number = b
            held.append(packed.as_py())
    if held:
        yield number, held


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    if len(keys):
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        yield from zip(starts.tolist(), np.append(starts[1:], len(keys)).tolist())
