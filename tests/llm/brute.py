"""Plain versions of what the queries must return, over lists of (doc_id, text, ...)."""

import bisect
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def mix_targets(sizes_by_source, cap=3):
    """Targets by the rule itself: reshare the excess by weight until no source is above its cap."""
    order = sorted((s for s in sizes_by_source if s is not None)) + ([None] if None in sizes_by_source else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes_by_source.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left, share = total - sum(capped.values()), sum(weight[s] for s in free)
        targets = capped | {s: left * weight[s] / share for s in free}
        above = [s for s in free if targets[s] > cap * sizes_by_source[s]]
        if not above or not total:
            return {s: t if total else 0.0 for s, t in targets.items()}
        capped |= {s: cap * sizes_by_source[s] for s in above}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if valid:
                found.append((m.start(), order, kind, m.end()))
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def fingerprint(text, n=3):
    own = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + n]).encode(), 42) for i in range(max(1, len(own) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids, radius=2):
    """Smallest identifier reachable over pairs within the radius."""
    values = np.array(prints, np.uint64)
    label = np.array(ids)
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= radius) for v in values]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label.tolist()
        label = new


def rule_stats(text):
    own = words(text)
    windows = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    covered = {i + k for i in range(len(own) - 2) if windows[tuple(own[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def without_repeats(docs, window=13):
    """(id, words, removed, digest of the rest) of (id, text) rows."""
    first, split = {}, [words(text) for _, text in docs]
    for (doc, _), own in zip(docs, split):
        for i in range(len(own) - window + 1) if doc is not None else ():
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), own in zip(docs, split):
        gone = set()
        for i in range(len(own) - window + 1) if doc is not None else ():
            if first[tuple(own[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((doc, len(own), len(gone), sha(" ".join(w for i, w in enumerate(own) if i not in gone))))
    return out


def nearest(vectors, query, k=5):
    """The k nearest of {id: vector} to one of them: (id, cosine)."""
    q = np.array(vectors[query], np.float64)
    found = []
    for other, v in vectors.items():
        if other != query:
            v = np.array(v, np.float64)
            found.append((-float((q * v).sum() / math.sqrt((q * q).sum()) / math.sqrt((v * v).sum())), other))
    return [(other, -score) for score, other in sorted(found)[:k]]


def contaminated(docs, items, window=10):
    """(id, words, hit, items, digest of the items) of (id, text) rows against (item, text) rows."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def split(text):
        return word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    holders = {}
    for item, text in items:
        own = split(text)
        n = min(len(own), window)
        for i in range(len(own) - n + 1) if n else ():
            holders.setdefault(tuple(own[i : i + n]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in holders}
    out = []
    for doc, text in docs:
        own, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                if (passage := tuple(own[i : i + n])) in holders:
                    hit |= set(range(i, i + n))
                    found |= holders[passage]
        out.append((doc, len(own), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def alignments(docs, left, right):
    """(id, a, b, groups, links, best, sum of counts, digest) of (id, text, a tokens, b tokens); tokens are (id, bytes).

    ``left`` and ``right`` give the tokens of a text.
    """
    rows, counts = [], Counter()
    for doc, text in docs:
        a, b = (left(text), right(text)) if text else ([], [])
        spelled = b" " + (text or "").encode()
        if b"".join(t for _, t in a) != spelled or b"".join(t for _, t in b) != spelled:
            a, b = [], []
        ends_a, ends_b = [], []
        for tokens, ends in ((a, ends_a), (b, ends_b)):
            at = 0
            for _, piece in tokens:
                at += len(piece)
                ends.append(at)
        shared = sorted(set(ends_a) & set(ends_b))
        sides = [[[] for _ in shared] for _ in "ab"]
        for side, tokens, ends in ((sides[0], a, ends_a), (sides[1], b, ends_b)):
            for (token, _), end in zip(tokens, ends):
                side[bisect.bisect_left(shared, end)].append(token)
        groups = [f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in zip(*sides)]
        links = [(x[-1], y[-1]) for x, y in zip(*sides)]
        counts.update(links)
        rows.append((doc, len(a), len(b), links, groups))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (doc, n_a, n_b, len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
         sha(";".join(groups)) if n_a else "")
        for doc, n_a, n_b, links, groups in rows
    ]


def in_turns(rows):
    """{conversation: its (role, text) in order} of (conv, turn, role, text) rows."""
    found = {}
    for conv, turn, role, text in sorted(
        (r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    ):
        found.setdefault(conv, []).append((role or "", text or ""))
    return found


def rebuilt(own):
    """The same, with the first turns of each conversation taken from every fifth one."""
    out = {}
    for conv, turns in own.items():
        taken = zlib.crc32(str(conv).encode()) % 9
        base = conv - int(math.fmod(conv, 5))
        out[conv] = own.get(base, [])[:taken] + turns[taken:]
    return out


def prefix_nodes(sequences):
    """(smallest member, depth, parent's, members, children, leaves, saved bytes, digest of the ends) of each beginning."""
    members = {}
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return [
        (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
         sha(",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(node))))
        for node, convs in members.items()
    ]


def rule_cutoffs(rows, factors, alpha, delta, steps=100):
    """{stratum: {rule: cutoff}} from (stratum, label or None, {rule: step}) rows, by the rules as stated."""
    def binomial(n, k):
        return sum(math.comb(n, i) * alpha**i * (1 - alpha) ** (n - i) for i in range(k + 1))

    strata = {s for s, label, _ in rows if label is not None}
    out = {}
    for stratum in strata:
        own = [(label, at) for s, label, at in rows if s == stratum]
        bad, good = [[at for label, at in own if label is not None and (label == 1) == g] for g in (False, True)]
        others = [at for label, at in own if label is None]
        best = (0.0, None)
        for factor in factors:
            cuts = {}
            for rule in (own[0][1] if bad and good else ()):
                for step in range(steps + 1):
                    share = sum(at[rule] >= step for at in bad) / len(bad)
                    usual = max(sum(at[rule] >= step for at in others) / max(len(others), 1), 1 / (len(others) + 1))
                    if share / usual >= factor:
                        cuts[rule] = step
                        break
            lost, caught = (sum(any(at[r] >= c for r, c in cuts.items()) for at in group) for group in (good, bad))
            if not bad or not good or binomial(len(good), lost) > delta / len(strata):
                break
            gain = caught / len(bad) - lost / len(good)
            if gain > best[0] + 1e-12:
                best = (gain, cuts)
        if best[1] is not None:
            out[stratum] = best[1]
    return out
