"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keep_lines(rows, min_chars=20, min_docs=3):
    """Of (doc_id, text) rows: the kept text and the number of dropped lines of each row. A null id is the smallest."""
    order = lambda i: (i is not None, i or 0)
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)], key=order) == doc_id]
        out.append(("\n".join(kept), len(lines) - len(kept)))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_components(rows):
    """doc_id -> smallest id reachable, by comparing all pairs; rows of one id are one document."""
    sets = defaultdict(set)
    for doc_id, text in rows:
        sets[doc_id].add(shingles(text))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            linked = any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])
            if a < b and linked:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}


def item_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def contaminated(docs, items, masks, least, percent, shift):
    """(doc_id, item_id) pairs by laying every item over every place of every document."""
    found = set()
    span = len(masks[0])
    for doc_id, text in docs:
        doc = item_words(text)
        for item_id, item_text in items:
            item = item_words(item_text)
            if len(item) < least:
                continue
            layers = {}
            for layer in range(-len(item) + 1, len(doc)):
                same = {p for p in range(len(item)) if 0 <= layer + p < len(doc) and doc[layer + p] == item[p]}
                if len(item) < span:
                    hit = len(same) == len(item)
                else:
                    inside = lambda at: 0 <= layer + at and layer + at + span <= len(doc)
                    hit = any(
                        inside(at) and all(m == "0" or at + k in same for k, m in enumerate(mask))
                        for mask in masks
                        for at in range(len(item) - span + 1)
                    )
                if hit:
                    layers[layer] = same
            for layer in layers:
                near = set().union(*(s for other, s in layers.items() if abs(other - layer) <= shift))
                if 100 * len(near) >= percent * len(item):
                    found.add((doc_id, item_id))
    return found


def best_unigram_split(name, counts, total, longest):
    """The likeliest split, by trying all of them."""
    import math

    def chance(word):
        n = counts.get(word)
        return math.log(n / total) if n else math.log(10 / total) - len(word) * math.log(10)

    def splits(rest):
        if not rest:
            yield []
        for k in range(1, min(len(rest), longest) + 1):
            for more in splits(rest[k:]):
                yield [rest[:k], *more]

    return max(sum(map(chance, words)) for words in splits(name))




def _digest(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def merkle_leaf(values):
    return _digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def merkle_levels(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_digest("".join(levels[-1][k : k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def merkle_siblings(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at // fanout * fanout
        out.append([n for k, n in enumerate(level[first : first + fanout], first) if k != at])
        at //= fanout
    return out


def manifest(rows, fanout=2):
    """Of (doc_id, lang, leaf) rows: (doc_id, leaf, subroot, root, all siblings joined), sorted."""
    groups = defaultdict(list)
    for doc_id, lang, leaf in rows:
        groups[lang].append((doc_id is not None, doc_id, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: merkle_levels([leaf for *_, leaf in sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2]))], fanout) for g in names}
    top = merkle_levels([trees[g][-1][0] for g in names], fanout)
    out = []
    for k, g in enumerate(names):
        for at, (_, doc_id, leaf) in enumerate(sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2]))):
            path = merkle_siblings(trees[g], at, fanout) + merkle_siblings(top, k, fanout)
            out.append((doc_id, leaf, trees[g][-1][0], top[-1][0], "".join(sum(path, []))))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def phrases(rows, max_words=3, least=10, top=2000, percent=50):
    """Of (lang, text) rows: (lang, rank, phrase, a, l, r, n, score) rows."""
    counts = defaultdict(lambda: defaultdict(int))
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, max_words + 1):
                for at in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[at : at + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = defaultdict(int)
        for p, c in candidates.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    inside[p[at : at + size]] = max(inside[p[at : at + size]], c)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= percent * a and inside[p]:
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), a, left, right, score))
        for rank, (_, _, phrase, a, left, right, score) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n, score))
    return sorted(out)


def model_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def base_scores(rows):
    """Of (text, learnt) rows: (n_tokens, n_known, train_tokens, base score) rows."""
    import math

    counts = defaultdict(int)
    for text, learnt in rows:
        for token in model_tokens(text) if learnt else ():
            counts[token] += 1
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for text, _ in rows:
        tokens = model_tokens(text)
        base = sum(math.log10((counts.get(t, 0) + 1) / (total + kinds + 1)) for t in tokens)
        out.append((len(tokens), sum(t in counts for t in tokens), total, base))
    return out


def interpolated(rows, order, parts, buckets, rounds, settled):
    """Scores of texts by the same model, token by token: ``parts`` names each text's part (0 retained, 1 held, 2 other)."""
    import math

    def grams(text):
        tokens = ["<"] * (order - 1) + model_tokens(text)
        for at in range(order - 1, len(tokens)):
            yield [tuple(tokens[at - k : at + 1]) for k in range(order)]

    def count(wanted):
        whole, context, kinds = defaultdict(int), defaultdict(int), set()
        for text, part in zip(rows, parts):
            if part in wanted:
                for sequence in grams(text):
                    kinds.add(sequence[0])
                    for s in sequence:
                        whole[s] += 1
                        context[len(s), s[:-1]] += 1
        return whole, context, len(kinds)

    def chances(sequence, model):
        whole, context, kinds = model
        out, at = [1 / (kinds + 1)], []
        for s in sequence:
            of = context[len(s), s[:-1]]
            out.append(whole[s] / of if of else 0.0)
            at.append(min(of.bit_length(), buckets - 1))
        return out, at

    def shares(out, at, weights):
        got, rest = [0.0] * len(out), 1.0
        for k in range(order, 0, -1):
            w = weights[k - 1][at[k - 1]]
            got[k] = rest * w * out[k]
            rest *= 1 - w
        got[0] = rest * out[0]
        return got

    weights = [[0.0] + [0.5] * (buckets - 1) for _ in range(order)]
    model = count({0})
    held = [chances(s, model) for text, part in zip(rows, parts) if part == 1 for s in grams(text)]
    for _ in range(rounds if held and model[2] else 0):
        own, upto = defaultdict(float), defaultdict(float)
        for out, at in held:
            got = shares(out, at, weights)
            for k in range(order):
                own[k, at[k]] += got[k + 1] / sum(got)
                upto[k, at[k]] += sum(got[: k + 2]) / sum(got)
        new = [[own[k, b] / upto[k, b] if b and upto[k, b] > 0 else w for b, w in enumerate(weights[k])] for k in range(order)]
        moved = max(abs(a - b) for x, y in zip(new, weights) for a, b in zip(x, y))
        weights = new
        if moved < settled:
            break
    model = count({0, 1})
    return [sum(math.log10(sum(shares(*chances(s, model), weights))) for s in grams(text)) for text in rows]
