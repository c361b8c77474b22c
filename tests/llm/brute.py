"""Plain Python versions of operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from math import log2, sqrt

from flowtables.llm import quality_rules as rules


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if len(w) >= 5:
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def near_groups(texts, percent):
    """(set size, smallest member of the group, kept) by document, holding all pairs together."""
    sets = {k: shingle_set(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {k: (len(sets[k]), top(k), top(k) == k) for k in texts}


def contaminated(texts, items, percent=80):
    sets = {k: shingle_set(t) for k, t in items.items()}
    found = set()
    for doc, text in texts.items():
        own = shingle_set(text)
        found |= {
            (doc, i) for i, s in sets.items() if s and 100 * len(s & own) >= percent * len(s)
        }
    return found


def recurring_lines(texts, min_docs=3, min_tokens=5, depth=3):
    """(document, line number) of the lines that the template tree drops."""
    leaves, placed = defaultdict(lambda: defaultdict(set)), []
    for doc, text in texts.items():
        for number, line in enumerate((text or "").split("\n")):
            tokens = tuple(words(re.sub("[0-9]+", "<*>", line)))
            if len(tokens) >= min_tokens:
                leaf = (len(tokens), tokens[:depth])
                leaves[leaf][tokens].add(doc)
                placed.append((doc, number, leaf, tokens))
    shapes = {}
    for leaf, variants in leaves.items():
        if len(variants) > 1:
            support = Counter()
            for tokens, docs in variants.items():
                for place in enumerate(tokens):
                    support[place] += len(docs)
            for tokens in variants:
                n, fixed = len(tokens), [support[place] >= min_docs for place in enumerate(tokens)]
                variable, behind = n - sum(fixed), n - depth
                kept = behind - variable
                if 2 * sum(fixed) >= n and 2 * kept >= behind and (4 * variable <= behind or kept >= 20):
                    shapes[tokens] = tuple(t if f else "<*>" for t, f in zip(tokens, fixed))
    holders = defaultdict(set)
    for doc, _, _, tokens in placed:
        holders[shapes.get(tokens, tokens)].add(doc)
    out = set()
    for doc, number, leaf, tokens in placed:
        owners, same = holders[shapes.get(tokens, tokens)], leaves[leaf][tokens]
        if len(owners) >= min_docs:
            if doc != min(owners):
                out.add((doc, number))
        elif len(tokens) >= 50 and doc != min(same):
            out.add((doc, number))
    return out


def _class_counts(text):
    import regex

    count = [len(regex.findall(f"[{c}]", text)) for c in rules.CLASSES.values()]
    symbols = sum(text.count(c) for c in rules.SYMBOLS)
    gaps = len(text) - sum(map(len, words(text)))
    return [*count, symbols, gaps, len(text) - sum(count) - symbols - gaps]


def _distance(p, q):
    total = sum(
        (a * log2(2 * a / (a + b)) if a else 0) + (b * log2(2 * b / (a + b)) if b else 0)
        for a, b in zip(p, q)
    )
    return sqrt(max(total / 2, 0))


def _shares(counts):
    return [c / max(sum(counts), 1) for c in counts]


def quality_rules(docs):
    out, sums = [], defaultdict(lambda: [Counter(), Counter(), 0])
    for d in docs:
        text, w = d["text"] or "", words(d["text"])
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {
            j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)
        }
        lines = [x for x in text.split("\n") if words(x)]
        classes = _class_counts(text)
        known = Counter(x.lower() for x in w)
        common = [known[v] for v in rules.VOCABULARY]
        common.append(len(w) - sum(common))
        row = {
            "doc_id": d["doc_id"],
            "n_words": len(w),
            "word_chars": sum(map(len, w)),
            "n_symbols": classes[len(rules.CLASSES)],
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered),
            "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w),
        }
        out.append((row, classes, common, len(text)))
        if d["lang"] and not row["base_failed"] and 100 * row["n_symbols"] <= len(text):
            sums[d["lang"]][0].update(dict(enumerate(classes)))
            sums[d["lang"]][1].update(dict(enumerate(common)))
            sums[d["lang"]][2] += len(w)
    refs = [
        [_shares([total[i] for i in range(n)]) for total, n in zip(v[:2], (6, len(rules.VOCABULARY) + 1))]
        for v in sums.values()
        if v[2] >= rules.MIN_REFERENCE_WORDS
    ]
    for row, classes, common, chars in out:
        n = row["n_words"]
        row["kept"] = not row["base_failed"] and (
            not refs
            or any(
                (chars < rules.MIN_CHARS or _distance(_shares(classes), c) <= rules.FAR_CLASSES)
                and (
                    n < rules.MIN_COMMON_WORDS
                    or _distance(_shares(common), v) <= rules.FAR_WORDS + rules.SHORT_WORDS / sqrt(n)
                )
                for c, v in refs
            )
        )
    return [o[0] for o in out]


def exact_groups(docs):
    """(keep_id, group size, digest) by row, for rows (doc_id, text)."""
    norm = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for _, t in docs]
    groups = defaultdict(list)
    for (i, _), t in zip(docs, norm):
        groups[t].append(i)
    return [
        (max((i for i in groups[t] if i is not None), default=None), len(groups[t]),
         hashlib.sha256(t.encode()).hexdigest())
        for t in norm
    ]


def spelling_forms(docs, min_chars=7, min_count=2, times=10):
    """word -> (form, root, n, n_near, form_n), holding all words of similar length together."""
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= min_chars and n >= min_count}

    def close(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = defaultdict(set)
    for a, b in combinations(count, 2):
        if abs(len(a) - len(b)) < 2 and close(a, b):
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w in count:
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= times * count[w] else None
    out = {}
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None)
    return out


def shared_heads(turns):
    """conversation -> turns (role, text) with lent heads, for rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[: h[c]] + v[h[c] :] for c, v in own.items()}


def prefix_trie(convs):
    """Rows of the trie of {conversation: turns}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = Counter(), Counter()
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        if node:
            saved[node] += (len(members[node]) - 1) * len(node[-1][1])
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return {
        (m[0], len(node)): (
            members[node[:-1]][0] if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(node)).encode()).hexdigest(),
        )
        for node, m in members.items()
    }
