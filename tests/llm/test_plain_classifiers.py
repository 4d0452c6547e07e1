"""The three classifiers against versions that go row by row, word by word and weight by weight."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from odd import odd_rows, prose
from siltstone.llm import language, quality, toxicity
from siltstone.llm.labelled import Held


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


# toxicity: FTRL-proximal


def plain_ftrl(rows, marks, how):
    """(weight by place, bias), one coordinate after the other."""
    state = {}

    def weight(place):
        z, n = state.get(place, (0.0, 0.0))
        l1 = 0.0 if place == "bias" else how.l1
        if abs(z) <= l1:
            return 0.0
        return -(z - math.copysign(l1, z)) / ((how.beta + math.sqrt(n)) / how.alpha + how.l2)

    for _ in range(how.passes):
        for places, y in zip(rows, marks):
            own = {place: weight(place) for place in [*places, "bias"]}
            g = sigmoid(sum(own.values())) - y
            for place, w in own.items():
                z, n = state.get(place, (0.0, 0.0))
                sigma = (math.sqrt(n + g * g) - math.sqrt(n)) / how.alpha
                state[place] = (z + g - sigma * w, n + g * g)
    return {place: w for place in state if place != "bias" and (w := weight(place))}, weight("bias")


def labelled_texts(n, seed=3):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        words = prose(seed * 1000 + i, rng.randint(3, 25)).split()
        if i % 2:
            words.insert(rng.randrange(len(words)), rng.choice(["moron", "loser", "Moron!"]))
        made.append((" ".join(words), float(i % 2)))
    return made


@pytest.mark.parametrize("how", [toxicity.Ftrl(), toxicity.Ftrl(alpha=0.3, beta=0.5, l1=0.2, l2=0.1, passes=2)])
def test_ftrl(how):
    texts, marks = zip(*labelled_texts(60))
    rows = [places.tolist() for places in toxicity._distinct(pa.array(texts))]
    held = Held(10**6)
    for places in rows:
        held.add(np.array(places, np.int32))
    found = toxicity._fit(list(marks), held, how)
    weights, bias = plain_ftrl(rows, marks, how)
    # State is kept in 32 bits: weights next to the threshold may differ in whether they are there.
    got = dict(zip(found.places.tolist(), found.values.tolist()))
    assert len(weights) > 10
    assert all(abs(got.get(p, 0.0) - weights.get(p, 0.0)) < 2e-3 for p in {*got, *weights})
    assert found.bias == pytest.approx(bias, abs=1e-3)
    used = np.zeros(1 << toxicity.BITS, bool)
    used[found.places] = True
    scores = toxicity._scores(pa.array([*texts, "", None]), found, used)
    expected = [sigmoid(sum(weights.get(p, 0.0) for p in places) + bias) for places in [*rows, [], []]]
    assert scores.tolist() == pytest.approx(expected, abs=3e-3)


# language: expectation-maximisation over words, and the choice of the set


def places_of(data):
    return language._places(np.frombuffer(data, np.uint8), np.array([0, len(data)]))


def plain_languages(text, model):
    """(prediction, score, set) of one text, word by word."""
    data = (text or "").encode()
    words, at = [], 0
    while at < len(data):
        end = at
        while end < len(data) and not language._NO_LETTER[data[end]]:
            end += 1
        if end > at:
            words.append((at, end))
        at = max(end, at + 1)
    if not words or not any(c.isalpha() for c in text):
        return language.UNKNOWN, 0.0, set()
    places = places_of(data).tolist()
    size = len(model.languages)
    likely, single = [], [0.0] * size
    for start, end in words:
        logs = [sum(float(model.logs[k][p]) for p in places[start:end]) for k in range(size)]
        likely.append([math.exp(max(value - max(logs), -30.0)) for value in logs])
        single = [total + math.log(value) for total, value in zip(single, likely[-1])]

    def mixture(allowed):
        share = [1 / len(allowed) if k in allowed else 0.0 for k in range(size)]
        for _ in range(language.ROUNDS):
            parts = []
            for own in likely:
                joint = [a * b for a, b in zip(own, share)]
                parts.append([x / sum(joint) for x in joint])
            share = [sum(part[k] for part in parts) / len(parts) for k in range(size)]
        return share, sum(math.log(sum(a * b for a, b in zip(own, share))) for own in likely)

    cost = language.PENALTY * math.log(1 + len(words))
    best = max(range(size), key=lambda k: (single[k], -k))
    value, pick = single[best] - cost, [float(k == best) for k in range(size)]
    shares, whole = mixture(set(range(size)))
    rank = sorted(range(size), key=lambda k: (-shares[k], k))
    for k in range(2, size + 1):
        if whole - k * cost <= value:
            break
        share, gained = mixture(set(rank[:k]))
        if gained - k * cost > value:
            value, pick = gained - k * cost, share
    first = max(range(size), key=lambda k: (pick[k], -k))
    return model.languages[first], pick[first], {model.languages[k] for k in range(size) if pick[k] > 0}


def test_mixture_and_set_choice():
    alphabets = {"aa": "abcdef", "bb": "efghij", "cc": "klmnoé", "dd": "abklxy"}
    rng = random.Random(1)

    def words(name, n):
        return " ".join("".join(rng.choice(alphabets[name]) for _ in range(rng.randint(2, 8))) for _ in range(n))

    counts = np.full((4, language.PLACES), language.PRIOR)
    for k, name in enumerate(alphabets):
        text = words(name, 3000).encode()
        counts[k] += np.bincount(places_of(text)[~language._NO_LETTER[np.frombuffer(text, np.uint8)]], minlength=language.PLACES)
    model = language.Model(list(alphabets), np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))
    rows = [" ".join(words(name, rng.randint(0, 40)) for name in rng.sample(sorted(alphabets), rng.randint(1, 4))) for _ in range(40)]
    rows += [None, "", "12 34", "€ €", "x", *[words("aa", 50) + " " + words("cc", 50)]]
    found = language._chosen(pa.array(rows, pa.string()), model).to_pylist()
    several = 0
    for text, got in zip(rows, found):
        lang, score, chosen = plain_languages(text, model)
        assert (got["lang_pred"], {*filter(None, got["languages"].split(","))}) == (lang, chosen)
        assert got["score"] == pytest.approx(score, abs=1e-6)
        several += len(chosen) > 1
    assert several > 5


# quality: regression, calibration and verdict


def plain_quality(rows, y, steps=120, ridge=1e-3):
    """(weight by place, bias, slope, shift) with one loop a row and a weight."""
    used = sorted({p for places, _ in rows for p in places})
    n = len(rows)
    features = [dict(zip(places, values)) for places, values in rows]
    mean = {p: sum(f.get(p, 0.0) for f in features) / n for p in used}
    square = {p: sum(f.get(p, 0.0) ** 2 for f in features) / n for p in used}
    scale = {p: 1 / (math.sqrt(max(square[p] - mean[p] ** 2, 0)) + 1e-4) for p in used}
    held = [i % quality.CALIBRATION == quality.CALIBRATION - 1 for i in range(n)]
    w, bias = dict.fromkeys(used, 0.0), math.log((sum(y) + 1) / (n - sum(y) + 1))
    first, second = {p: 0.0 for p in [*used, "bias"]}, {p: 0.0 for p in [*used, "bias"]}

    def margin(f):
        return bias + sum(value * scale[p] * w[p] for p, value in f.items())

    for step in range(1, steps + 1):
        slope = {p: ridge * w[p] for p in used} | {"bias": 0.0}
        for f, mark, kept_back in zip(features, y, held):
            if not kept_back:
                error = (sigmoid(margin(f)) - mark) / (n - sum(held))
                slope["bias"] += error
                for p, value in f.items():
                    slope[p] += value * scale[p] * error
        for p, g in slope.items():
            first[p], second[p] = 0.9 * first[p] + 0.1 * g, 0.99 * second[p] + 0.01 * g * g
            move = 0.02 * (first[p] / (1 - 0.9**step)) / (math.sqrt(second[p] / (1 - 0.99**step)) + 1e-8)
            if p == "bias":
                bias -= move
            else:
                w[p] -= move
    pairs = [(margin(f), mark) for f, mark, kept_back in zip(features, y, held) if kept_back]
    yes = sum(mark for _, mark in pairs)
    targets = [(yes + 1) / (yes + 2) if mark else 1 / (len(pairs) - yes + 2) for _, mark in pairs]
    # The calibration's optimum, by many small steps down the same loss.
    a, b = 1.0, 0.0
    for _ in range(200_000):
        ga, gb = 1e-6 * a, 1e-6 * b
        for (x, _), target in zip(pairs, targets):
            error = sigmoid(a * x + b) - target
            ga, gb = ga + error * x, gb + error
        if abs(ga) + abs(gb) < 1e-9:
            break
        a, b = a - 0.02 * ga, b - 0.02 * gb
    return {p: w[p] * scale[p] for p in used}, bias, (a, b) if a > 0 else (1.0, 0.0)


def test_regression_calibration_and_verdict():
    rng = random.Random(5)
    texts, y = [], []
    for i in range(44):
        words = prose(900 + i, rng.randint(10, 16)).split()
        if i % 2:
            words = [word + rng.choice(["", "&&&", "$$"]) for word in words]
        if rng.random() < 0.15:
            words = [word + "&&&" if i % 2 == 0 else word.strip("&$") for word in words]
        texts.append(" ".join(words))
        y.append(float(i % 2 == 0))
    rows = quality._frequencies(pa.array(texts))
    model = quality._fit(np.array(y), rows)
    weights, bias, (slope, shift) = plain_quality([(p.tolist(), v.tolist()) for p, v in rows], y)
    got = np.concatenate([model.words, model.runs])
    assert all(got[p] == pytest.approx(w, rel=2e-3, abs=2e-3) for p, w in weights.items())
    assert model.bias == pytest.approx(bias, abs=1e-4)
    assert (model.slope, model.shift) == pytest.approx((slope, shift), rel=1e-2, abs=1e-2)
    checked = [*texts, *[text for _, text in odd_rows()[:12]]]
    found = quality._judged(pa.array(checked, pa.string()), model).to_pylist()
    for (places, values), own in zip(quality._frequencies(pa.array(checked, pa.string())), found):
        margin = bias + sum(value * weights.get(p, 0.0) for p, value in zip(places.tolist(), values.tolist()))
        probability = sigmoid(slope * margin + shift)
        assert own["probability"] == pytest.approx(probability, abs=1e-2)
        if abs(probability - quality.MIN_PROBABILITY) > 1e-2:
            assert own["kept"] == (not own["base_failed"] and probability >= quality.MIN_PROBABILITY)
