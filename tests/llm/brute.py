"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def secrets(text):
    text, spans = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, m.end(), "assign"))
    for k, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)), 1):
        spans += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    n = Counter(s[3] for s in spans)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)).encode()).hexdigest()


def quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


PHRASES = re.compile(r"licensed under|all rights reserved|copyright [0-9]|©|cookie (policy|settings)|privacy policy|terms of (use|service)|click here|subscribe (now|to)|sign (in|up)|log ?in|enable javascript|powered by", re.I | re.A)


def cleaned(text):
    """(kept, text without failing lines) by the rules of lines."""
    good, all_chars, lost, phrases = [], 0, 0, 0
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            good.append(line)
            continue
        if PHRASES.search(line):
            phrases += len(line)
            continue
        n, letters = len(words), len(regex.findall(r"\p{L}", line))
        bad = len(re.findall(r"[#*$%&|<>]", line)) + len(re.findall("!!+", line)) > 0.3 * n
        bad |= 2 * len(re.findall(r"(?:^|[\x20\x09])[|•·»>]", line)) >= n
        bad |= letters >= 20 and len(regex.findall(r"\p{Lu}", line)) > 0.6 * letters
        bad |= n >= 8 and len(set(words)) < 0.25 * n
        all_chars += len(line)
        lost += len(line) * bad
        if not bad:
            good.append(line)
    return not quality(text)[-1] and all_chars > 0 and lost <= 0.5 * all_chars and phrases + lost <= 0.8 * (phrases + all_chars), "\n".join(good)


def shingles(text, size=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def contaminated(docs, bench, template, known, size, literals, least=0.4):
    """{(doc_id, item_id): (matched, all)} windows of templates whose slots follow the mapping of most pairs of an alignment."""

    def listed(text):
        hashes, kind, number, _ = template([text], known)
        at = [a for a in range(len(hashes) - size + 1) if (kind[a : a + size] == 0).sum() >= literals]
        return [(a, tuple(hashes[a : a + size].tolist()), [known.words[number[x]] for x in range(a, a + size) if kind[x]]) for a in at]

    own, out = {i: listed(t) for i, t in bench.items()}, {}
    for d, text in docs.items():
        found = listed(text)
        for i, windows in own.items():
            runs = {}
            for a, key, slots in found:
                for b, other, values in windows:
                    if key == other:
                        runs.setdefault(a - b, {})[b] = list(zip(values, slots, strict=True))
            places = set()
            for rows in runs.values():
                pairs = [p for r in rows.values() for p in r]
                best = {v: max((sum(q == (v, x) for q in pairs), x) for w, x in pairs if w == v)[1] for v, _ in pairs}
                places |= {b for b, r in rows.items() if all(best[v] == x for v, x in r)}
            if windows and len(places) >= least * len(windows):
                out[d, i] = (len(places), len(windows))
    return out


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(nodes, near):
    """nodes: {id: value}; the smallest id of each one's component under near(value, value)."""
    ids, up = sorted(nodes), {i: i for i in nodes}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if near(nodes[a], nodes[b]):
                ra, rb = find(a), find(b)
                up[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


def removed(docs, size=50):
    """docs: {doc_id: text}; per document its words and the indices that repeated windows cover."""
    words, first = {d: WORD.findall(t or "") for d, t in docs.items()}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i : i + size]), d)
    return {d: (w, {j for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < d for j in range(i, i + size)}) for d, w in words.items()}


def line_runs(docs, least_lines=1):
    """docs: {doc_id: text}; per document n_lines, n_removed, longest_run, n_runs and the kept text, from maximal repeated runs."""
    lines = {d: [(p, x.strip(" \t\n\x0b\x0c\r")) for p, x in enumerate(t.split("\n")) if WORD.search(x)] for d, t in docs.items() if t is not None}
    seqs = {d: [x for _, x in v] for d, v in lines.items()}
    places = [(d, i) for d in sorted(seqs) for i in range(len(seqs[d]))]

    def common(a, b):
        v, w, n = seqs[a[0]][a[1] :], seqs[b[0]][b[1] :], 0
        while n < min(len(v), len(w)) and v[n] == w[n]:
            n += 1
        return n

    run = {a: max((common(a, b) for b in places if a != b), default=0) for a in places}
    gone = {d: set() for d in docs}
    for k, a in enumerate(places):  # the longest run from here that began earlier
        n = max((common(a, b) for b in places[:k]), default=0)
        if n >= least_lines:
            gone[a[0]] |= {lines[a[0]][i][0] for i in range(a[1], a[1] + n)}
    out = {}
    for d, t in docs.items():
        runs = [run[d, i] for i in range(len(seqs.get(d, ())))]
        maximal = sum(r >= least_lines and (i == 0 or runs[i - 1] <= r) for i, r in enumerate(runs))
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])
        out[d] = (len(runs), len(gone[d]), max(runs, default=0), maximal, kept)
    return out
