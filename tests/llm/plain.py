"""Plain versions of the operators, without Spark, and odd rows to try them on."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, score double"
LINE = "a line that many documents share"
BASE = " ".join(f"word{i}" for i in range(120))


def odd_documents() -> list[tuple]:
    texts = [
        None,
        "",
        "   \n\t",
        "short\nshort\nshort",
        f"{LINE}\nown line of three\n{LINE}",
        f"  {LINE.upper()}  \nanother line here\n\n",
        f"{LINE}\n{LINE}\x0b",
        "one two",
        "One Two",
        BASE,
        BASE + " tail",
        BASE.upper(),
        "été naïve 中文 \U0001f600 " * 5,
        " ".join(f"long{i % 997}" for i in range(40_000)),
        "password = hunter2222\napi-key: x\nSECRET='abc+/def='; tokenize: abcdef",
        "12345 !!! 678",
    ]
    rows = [(i * 3 + 1, t, ["en", "fr", None][i % 3], ["src0", "src1", None][i % 3], None, "k", 0.5) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[9], (None, LINE, "en", "src0", 1, None, None), (100, LINE, None, None, None, None, None)]


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def line_dedup(docs: list[tuple]) -> dict:
    """doc_id -> (n_lines, n_dropped, kept text); ids are distinct."""
    first: dict[str, int] = {}
    held: dict[str, set] = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = lower(line.strip(" \t\n\x0b\f\r"))
            if len(key) >= 10:
                held.setdefault(key, set()).add(doc)
    first = {k: min(v) for k, v in held.items() if len(v) > 1}
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(lower(x.strip(" \t\n\x0b\f\r")), doc) == doc]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids: list, linked) -> dict:
    """id -> smallest id reachable, by union of all linked pairs."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def simhash(docs: list[tuple], radius: int = 2) -> dict:
    prints = {doc: fingerprint(text) for doc, text in docs}
    ids = sorted(prints)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= radius]
    found = classes(ids, linked)
    return {i: (prints[i], found[i]) for i in ids}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(docs: list[tuple], items: list[tuple], width: int = 13) -> dict:
    """doc_id -> (n_words, n_hit, item ids as sorted text)."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                holders = windows.get(tuple(w[i : i + size]))
                if holders:
                    hit.update(range(i, i + size))
                    found |= holders
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def tokens(docs: list[tuple], tokenizer) -> dict:
    """doc_id -> (start, n_tokens, crc) in the order of ids; ids are distinct."""
    out, start = {}, 0
    for doc, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out[doc] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def trie(rows: list[tuple], shared_of: int = 100, shared_turns: int = 5) -> set[tuple]:
    """Nodes of the trie of (conv_id, turn, role, text) as rows of the operator; turns do not tie."""
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: t[:2])
    whole = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % (shared_turns + 1)
        base = conv - (conv % shared_of if conv >= 0 else -(-conv % shared_of))
        whole[conv] = tuple(t[2:] for t in [*own.get(base, [])[:h], *turns[h:]])
    members: dict[tuple, list[int]] = {}
    for conv in sorted(whole):
        for depth in range(len(whole[conv]) + 1):
            members.setdefault(whole[conv][:depth], []).append(conv)
    children, leaves, saved = ({node: 0 for node in members} for _ in range(3))
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:depth]] += children[node] == 0
    found = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if whole[c] == node)
        parent = members[node[:-1]][0] if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.add((convs[0], len(node), parent, len(convs), children[node], leaves[node], saved[node], digest))
    return found


def whitened(vectors: list, wanted: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Explained shares, deviations and whitened rows of equally long vectors, by numpy's eigenvalues; components in either sign."""
    x = np.floor(np.array(vectors, np.float64) * 256)
    fit = np.unique(x, axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(x.shape[1], -1))
    values, axes = values[::-1][:wanted], axes[:, ::-1][:, :wanted]
    deviations = [sum((len(fit) * int(a) - int(s)) ** 2 for a, s in zip(row, fit.sum(axis=0))) for row in x]
    return values / np.cov(fit.T, bias=True).trace(), np.array(deviations, object), (x - fit.mean(axis=0)) @ axes / np.sqrt(values)
