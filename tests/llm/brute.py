"""Each contract once more in plain Python, over lists of rows, with no thought for size."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np

ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def decontamination(docs, items, width=10):
    windows = {}
    for item_id, text in items:
        words = ALNUM_WORD.findall((text or "").translate(SMALL))
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + width]), set()).add(str(item_id))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words = ALNUM_WORD.findall((text or "").translate(SMALL))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                items_here = windows.get(tuple(words[i : i + n]))
                if items_here:
                    hit.update(range(i, i + n))
                    found |= items_here
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    ("hex", r"[0-9a-f]+", 0, 0, 24),
)


def secrets(docs):
    out = []
    for doc_id, text in docs:
        spans, counts = [], []
        for rank, (kind, pattern, flags, group, least) in enumerate(RULES):
            found = [m.span() for m in re.finditer(pattern, text or "", flags) if len(m.group(group)) >= least]
            counts.append(len(found))
            spans += [(start, rank, kind, end) for start, end in found]
        out.append((doc_id, *counts, sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)))))
    return out


def sentencepiece_rows(docs, model: bytes):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = []
    for doc_id, text in docs:
        ids = library.encode(text or "")
        out.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    return out


def repeats(docs, width=13):
    words = [(doc_id, BLANK_WORD.findall(text or "")) for doc_id, text in docs]
    least = {}
    for doc_id, w in words:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < doc_id:
                gone.update(range(i, i + width))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def near_groups(docs, n=5, percent=80):
    sets = {}
    for doc_id, text in docs:
        w = BLANK_WORD.findall((text or "").translate(SMALL))
        sets[doc_id] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    holders = {}
    for doc_id, shingles in sets.items():
        for s in shingles:
            holders.setdefault(s, []).append(doc_id)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, shingles in sets.items():
        common = {}
        for s in shingles:
            for b in holders[s]:
                if b > a:
                    common[b] = common.get(b, 0) + 1
        for b, m in common.items():
            if 100 * m >= percent * (len(shingles) + len(sets[b]) - m):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(d, len(sets[d]), root(d)) for d in sets]


def revisits(pages):
    first = {}
    for page_id, html in pages:
        body = (html or "").encode()
        first[body] = min(first.get(body, page_id), page_id)
    out = []
    for page_id, html in pages:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        original = first[body]
        same = original == page_id
        out.append((page_id, len(body), digest, "response" if same else "revisit", None if same else original))
    return out


def nearest(vectors, every=50, k=5):
    """Query id to the scores of all its candidates, best first."""
    good = []
    for vec_id, v in vectors:
        if vec_id is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float64)
        x /= np.abs(x).max()
        good.append((vec_id, x / np.linalg.norm(x)))
    ids = np.array([i for i, _ in good])
    matrix = np.stack([x for _, x in good])
    out = {}
    for vec_id, x in good:
        if vec_id % every == 0:
            cosines = matrix @ x
            out[vec_id] = sorted(((-c, int(i)) for c, i in zip(cosines, ids) if i != vec_id))[:k]
    return out


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
