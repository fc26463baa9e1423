"""Plain single-machine answers that the operators are held against."""

from __future__ import annotations

import hashlib
import re

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def sha(s) -> str:
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def base_secrets(text: str | None) -> tuple[int, int, int, str]:
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if m.end() - m.start() >= 16]
    kinds = ["assign", "access", "hex"]
    n = [sum(f[1] == k for f in found) for k in range(3)]
    return (*n, sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))))
