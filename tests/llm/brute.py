"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re

import pyarrow.parquet as pq

SF_DIR = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(name: str, sf_dir: str = SF_DIR) -> list[dict]:
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact_groups(docs: list[dict]) -> dict[int, tuple]:
    groups: dict[str, list] = {}
    for d in docs:
        text = d["text"] or ""
        groups.setdefault(SPACE.sub("", text), []).append((-len(text), d["doc_id"]))
    return {
        i: (min(g)[1], len(g), i == min(g)[1], sha(norm)) for norm, g in groups.items() for _, i in g
    }
