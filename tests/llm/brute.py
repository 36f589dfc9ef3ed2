"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = "[^\x20\x09-\x0d]+"


def repeats(rows, span):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i : i + span] for _, b in data for i in range(len(b) - span + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        rest = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def line_dedup(rows, least=10):
    """(doc_id, n_lines, n_dropped, kept text); a null doc_id is the last document."""
    order = lambda d: (d is None, d)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    owners = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                owners[key(line)].add(order(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or min(owners[key(x)]) == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text, words):
    w = re.findall(WORD, (text or "").translate(LOWER))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def near_duplicates(rows, words, percent=80):
    """(doc_id, set size, component_id, kept) for every row; rows are nodes."""
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        known = [x for x in (least.get(r), d) if x is not None]
        least[r] = min(known) if known else None
    return [(d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows)]


def plain_words(text):
    plain = re.sub(r"[\W_]+", " ", (text or "").lower()).strip(" ")
    return plain.split(" ") if plain else []


def contaminated(rows, items, words=5, percent=80):
    """{(doc_id, item_id)}: some item-sized window has the similarity, over all windows."""
    found = set()
    cut = lambda t: [tuple(t[i : i + words]) for i in range(len(t) - words + 1)]
    for item_id, text in items:
        want = cut(plain_words(text))
        if not want:
            continue
        need = collections.Counter(want)
        for d, t in rows:
            have = cut(plain_words(t))
            if not need.keys() & set(have):
                continue
            for start in range(max(1, len(have) - len(want) + 1)):
                window = collections.Counter(have[start : start + len(want)])
                common = sum((window & need).values())
                if 100 * common >= percent * sum((window | need).values()):
                    found.add((d, item_id))
                    break
    return found


def base_rules(text):
    t = text or ""
    w = re.findall(WORD, t)
    windows = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered, seen, dup = set(), set(), 0
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    for line in t.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def licenses(text, known, rules, variable, gap=2):
    """Sentences part by part, rules over positions: what a rule names is gone, what lies in its gaps stays."""
    t = (text or "").lower()
    parts, at = [], 0
    for m in re.finditer("[.!?:;]+([\x20\x09-\x0d]+|$)|\n", t):
        parts.append((t[at : m.start()], bool(set(m[0].strip()) & set(".!?"))))
        at = m.end()
    parts.append((t[at:], True))
    plain = [(re.sub("[^a-z0-9]+", " ", p).strip(" "), stop) for p, stop in parts]
    hits, i = [], 0
    while i < len(plain):
        best = None
        for j in range(i, min(len(plain), i + 30)):
            sentence = " ".join(p for p, _ in plain[i : j + 1])
            for k, v in known.items():
                if sentence == v and all(p for p, _ in plain[i : j + 1]):
                    best = (k, j)
            for k, head, tail in variable:
                if sentence.startswith(head + " ") and sentence.endswith(" " + tail) and len(head) + len(tail) + 2 < len(sentence):
                    best = best or (k, j)
            if plain[j][1] or not plain[j][0]:
                break
        if best:
            hits.append(best[0])
        i = best[1] + 1 if best else i + 1
    def places(left, identifiers, first, room):
        """The first places of the identifiers, nearer ones preferred."""
        for j in range(first, min(len(left), first + room)):
            if left[j] == identifiers[0]:
                rest = places(left, identifiers[1:], j + 1, gap + 1) if len(identifiers) > 1 else []
                if rest is not None:
                    return [j, *rest]
        return None

    left, count = list(hits), collections.Counter()
    for name, identifiers in rules:
        i = 0
        while i < len(left):
            taken = places(left, identifiers, i, 1)
            if taken:
                count[name] += 1
                for j in taken:
                    left[j] = None
                i = taken[-1]
            i += 1
        left = [x for x in left if x is not None]
    names = dict.fromkeys(n for n, _ in rules)
    return len(hits), "".join(hits), ";".join(f"{n}:{count[n]}" for n in names if count[n])
