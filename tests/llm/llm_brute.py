"""Plain versions of the operators' contracts, for small tables."""

import collections
import hashlib
import math
import re
import string
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [(x is None, x if x is not None else 0) for x in r[1:]]))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    count = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2)
               for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, rx) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in rx.finditer(text or ""):
            value = m.group()
            digits = re.sub("[^0-9]", "", value)
            if kind == "ip" and max(map(int, value.split("."))) > 255:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{e}" for a, k, e, kind in sorted(out))


def window_dedup(rows, k=13):
    """doc_id, n_words, n_removed, kept_sha256."""
    least = {}
    tokens = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in tokens:
        if i is not None:
            for a in range(len(w) - k + 1):
                key = tuple(w[a:a + k])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in tokens:
        gone = set()
        if i is not None:
            for a in range(len(w) - k + 1):
                if least[tuple(w[a:a + k])] < i:
                    gone.update(range(a, a + k))
        out.append((i, len(w), len(gone), sha256(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def jaccard_components(rows, n=4, percent=85):
    """doc_id, n_shingles, component_id, from all pairs."""
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        full = {tuple(w[a:a + n]) for a in range(len(w) - n + 1)}
        sets.append((i, full if len(w) >= n else ({tuple(w)} if w else set())))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = {}
    for k, (i, s) in enumerate(sets):
        if i is None:
            continue
        shared = collections.Counter(j for g in s for j in holders.get(g, ()))
        for g in s:
            holders.setdefault(g, []).append(k)
        for j, c in shared.items():
            if 100 * c >= percent * (len(s) + len(sets[j][1]) - c):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), None if i is None else least[find(k)]) for k, (i, s) in enumerate(sets)]


def bigram_losses(rows, target, spec, table):
    """doc_id -> (tokens, loss under target, loss under background), and the check that probabilities sum to one."""
    docs = [(i, (t or "").encode().translate(table).split()) for i, t in rows]
    total = sum(len(w) for _, w in docs)
    words = collections.Counter(x for _, w in docs for x in w)
    vocab = {w for w, k in words.items() if k * spec.vocab_share >= total}
    pairs, single = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()]
    coded = [(i, [x if x in vocab else 0 for x in w]) for i, w in docs]
    for i, x in coded:
        if x:
            for m in ([0, 1] if i in target else [0]):
                single[m].update([*x, "E"])
                pairs[m].update(zip(["E", *x], [*x, "E"], strict=True))
    sums = [sum(s.values()) for s in single]

    def p(m, v, w):
        p1 = (single[m][w] + spec.alpha) / (sums[m] + spec.alpha * (len(vocab) + 2))
        return (pairs[m][(v, w)] + spec.mu * p1) / (single[m][v] + spec.mu)

    for m in (0, 1):
        for v in ["E", 0, *sorted(vocab)[:2]]:
            assert abs(sum(p(m, v, w) for w in ["E", 0, *vocab]) - 1) < 1e-9
    out = {}
    for i, x in coded:
        a = out.setdefault(i, [0, 0, 0, 0])
        if x:
            a[0] += len(x)
            a[1] += len(x) + 1
            for v, w in zip(["E", *x], [*x, "E"], strict=True):
                a[2] += round(-math.log(p(1, v, w)) * 1e6)
                a[3] += round(-math.log(p(0, v, w)) * 1e6)
    return {i: (a[0], a[2] / a[1] / 1e6 if a[1] else None, a[3] / a[1] / 1e6 if a[1] else None) for i, a in out.items()}


def merkle(rows, fanout=16):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows (doc_id, source, lang, n_chars, text)."""
    def leaf(*fields):
        return sha256("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([sha256("".join(last[i:i + fanout])) for i in range(0, len(last), fanout)])
        return levels

    def path(levels, at):
        out = []
        for level in levels[:-1]:
            a = at - at % fanout
            out.append(("".join(level[a:at]), "".join(level[at + 1:a + fanout])))
            at //= fanout
        return out

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((leaf(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees.append(climb([x[0] for x in groups[g]]))
    top = climb([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for at, (own, r) in enumerate(groups[g]):
            steps = path(trees[k], at) + path(top, k)
            node = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = leaf(*r[:4], r[4] if r[4] is None else r[4].translate(LOWER))
            for left, right in steps:
                node = sha256(left + node + right)
            proof = sha256("".join(a + b for a, b in steps))
            out.append((r[0], own, trees[k][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def byte_dedup(rows, window=400):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(t[a:a + window] for _, t in texts for a in range(len(t) - window + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - window + 1):
            if count[t[a:a + window]] > 1:
                gone[a:a + window] = b"\x01" * window
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def collocations(rows, min_count=30, covered=80, top=2000):
    """lang, rank, phrase, a, l, r, n, score of rows (lang, text)."""
    count, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            lang = "und" if lang is None else lang
            total[lang] += len(w)
            for k in range(1, 5):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        cover = collections.Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    cover[p[i:i + k]] = max(cover[p[i:i + k]], a)
        best = []
        for p, a in found.items():
            if 100 * cover[p] >= covered * a:
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)
