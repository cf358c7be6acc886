"""The package as one archive for ``--py-files``, the same bytes for the same code."""

from __future__ import annotations

import hashlib
import json
import zipfile
from pathlib import Path

PACKAGE = Path(__file__).parents[1]
#: The first time that a zip entry can have.
EPOCH = (1980, 1, 1, 0, 0, 0)
MANIFEST = "tripmill-bundle.json"


def build(output: Path) -> dict:
    """Writes the archive and returns its manifest with the archive's digest.

    Entries are in order of their names, have one fixed time and mode, and are
    stored as they are, so the digest depends on no clock, disk or zlib version.
    The manifest inside has the digest of every file.
    """
    code = {str(f.relative_to(PACKAGE.parent).as_posix()): f.read_bytes() for f in PACKAGE.rglob("*.py")}
    manifest = {"package": PACKAGE.name, "entry_points": ["tripmill.plans.cli"], "files": {name: hashlib.sha256(code[name]).hexdigest() for name in sorted(code)}}
    content = code | {MANIFEST: json.dumps(manifest, sort_keys=True, separators=(",", ":")).encode()}
    output.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(output, "w", zipfile.ZIP_STORED) as archive:
        for name in sorted(content):
            entry = zipfile.ZipInfo(name, EPOCH)
            entry.create_system, entry.external_attr = 3, 0o644 << 16
            archive.writestr(entry, content[name])
    return manifest | {"sha256": hashlib.sha256(output.read_bytes()).hexdigest()}
