"""Fetches the ontology's flat files and records of which day they are."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable
from pathlib import Path
from urllib.request import urlopen

# The flat files that the first stage reads.
FILES = ("chebi.obo", "compounds.tsv.gz", "names.tsv.gz", "structures.tsv.gz", "chemical_data.tsv.gz", "relation.tsv.gz", "relation_type.tsv.gz")
RECORD = "release.json"


def fetch(urls: dict[str, str], folder: str, refresh: bool = False, opener: Callable = urlopen) -> dict[str, str | None]:
    """Files by name into a folder that executors see too; gives each one's Last-Modified, which ``release.json`` keeps.

    A file that is there stays, unless refresh. One that breaks off leaves nothing under its name.
    """
    base = Path(folder)
    base.mkdir(parents=True, exist_ok=True)
    record = base / RECORD
    known = json.loads(record.read_text()) if record.exists() else {}
    for name, url in urls.items():
        if (base / name).exists() and not refresh:
            continue
        part = base / f".{name}.part"
        with opener(url, timeout=120) as reply, part.open("wb") as out:
            shutil.copyfileobj(reply, out)
            known[name] = reply.headers.get("Last-Modified")
        os.replace(part, base / name)
        record.write_text(json.dumps(known, indent=2))
    return known
