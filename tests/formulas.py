"""The metric definitions in plain Python, for comparison on small inputs."""

import math
from collections import Counter


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def rouge(hyp, ref, n):
    h, r = grams(hyp, n), grams(ref, n)
    shared = sum((h & r).values())
    precision = shared / max(sum(h.values()), 1)
    recall = shared / max(sum(r.values()), 1)
    return 2 * precision * recall / (precision + recall) if precision + recall else 0.0


def bleu(items, first_run):
    """items: list of (hyp tokens, [ref tokens, ...])."""
    num, den, hyp_len, ref_len = [0] * 5, [0] * 5, 0, 0
    for hyp, refs in items:
        hyp_len += len(hyp)
        if first_run:
            ref_len += min((abs(len(r) - len(hyp)), len(r)) for r in refs)[1]
        else:
            ref_len += min(len(r) for r in refs)
        for n in range(1, 5):
            best = Counter()
            for ref in refs:
                best |= grams(ref, n)
            num[n] += sum((grams(hyp, n) & best).values())
            den[n] += max(1 if first_run else 0, len(hyp) - n + 1)
    if num[1] == 0 or (not first_run and min(num[1:]) == 0):
        return 0.0
    brevity = 1.0 if hyp_len > ref_len else math.exp(1 - ref_len / hyp_len)
    logs = [math.log((num[n] or 0.1) / den[n]) for n in range(1, 5)]
    return brevity * math.exp(sum(logs) / 4)


def _greedy(hyp, ref, fits):
    """Walk both sides from the end and pair what fits; used places are taken out."""
    pairs = []
    for place in sorted(hyp, reverse=True):
        for other in sorted(ref, reverse=True):
            if fits(hyp[place], ref[other]):
                pairs.append((place, other))
                del hyp[place], ref[other]
                break
    return pairs


def meteor(hyp, ref, stem=None, synonyms=None):
    left, right = dict(enumerate(hyp)), dict(enumerate(ref))
    pairs = _greedy(left, right, lambda a, b: a == b)
    if stem:
        left = {k: stem(v) for k, v in left.items()}
        right = {k: stem(v) for k, v in right.items()}
        pairs += _greedy(left, right, lambda a, b: a == b)
    if synonyms:
        pairs += _greedy(left, right, lambda a, b: b in synonyms.get(a, ()))
    pairs.sort()
    m = len(pairs)
    if not m:
        return 0, 0, 0.0
    chunks = 1 + sum(
        1 for (a, b), (c, d) in zip(pairs, pairs[1:]) if (c, d) != (a + 1, b + 1)
    )
    p, r = m / len(hyp), m / len(ref)
    return m, chunks, (1 - 0.5 * (chunks / m) ** 3) * p * r / (0.9 * p + 0.1 * r)
