"""Files of known genomes: where they lie, and whether they are whole.

Nothing is downloaded. A JSON file, named by the environment variable QUILLSEQ_GENOMES, says where each genome's files are:
{"hg38": {"chrom_sizes": path, "ccre": path, "dhs": path, "index": path prefix}, ...}. A file's "<path>.md5" or "<path>.sha256",
where there is one, holds its digest, and a file that differs from it is an error.
"""

from __future__ import annotations

import hashlib
import json
import os


def settings() -> dict[str, dict[str, str]]:
    path = os.environ.get("QUILLSEQ_GENOMES")
    if not path:
        raise ValueError("no genome files are set: name a JSON file in QUILLSEQ_GENOMES, or give the file itself")
    with open(path) as f:
        return json.load(f)


def digest(path: str, kind: str = "md5") -> str:
    h = hashlib.new(kind)
    with open(path, "rb") as f:
        for part in iter(lambda: f.read(1 << 20), b""):
            h.update(part)
    return h.hexdigest()


def path_of(kind: str, genome: str | None) -> str:
    """The path of a genome's file of a kind; local files are held against their digest, where there is one."""
    known = settings()
    if genome not in known or kind not in known[genome]:
        raise KeyError(f"no {kind} for {genome}; known: {', '.join(sorted(known))}")
    path = known[genome][kind]
    for sum_of in ("md5", "sha256"):
        if os.path.exists(f"{path}.{sum_of}"):
            with open(f"{path}.{sum_of}") as f:
                if f.read().split()[0] != digest(path, sum_of):
                    raise ValueError(f"{path} differs from its digest")
    return path
