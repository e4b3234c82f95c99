"""Secret scans: literals followed through constants, against a slow version, and time in proportion to the text."""

from __future__ import annotations

import random
import time

import pytest

from rollcall.llm import secret_scan
from rollcall.llm.secret_scan import THRESHOLD, literal_score, name_score, phrased

NAMES = ["password", "dbPassword", "token", "api_key", "alpha", "beta", "gamma", "cacheKey", "salt", "delta"]


def slow_flow(pairs):
    """pairs: (name, literal or name). The literals that some name of enough weight ends up with, by walking from each."""
    best = {}
    for sink in {name for name, _ in pairs}:
        weight = name_score(sink)
        reached, waiting = set(), [sink]
        while waiting:
            name = waiting.pop()
            if name in reached:
                continue
            reached.add(name)
            waiting += [value for other, value in pairs if other == name and value in NAMES]
        for name, value in pairs:
            if weight and name in reached and value not in NAMES:
                look = literal_score(value, phrased(sink))
                if look and weight + look >= THRESHOLD:
                    best[value] = max(best.get(value, 0), weight + look)
    return best


@pytest.mark.parametrize("seed", range(150))
def test_literals_flow_as_in_a_slow_version(seed):
    rng = random.Random(seed)
    pairs = []
    for n in range(rng.randrange(1, 25)):
        literal = rng.choice([f"xK9-{n}-Zq81vbn{n}", f"correct horse battery{n} staple", f"plain{n}word", f"0123{n}"])
        pairs.append((rng.choice(NAMES), rng.choice(NAMES) if rng.random() < 0.6 else literal))
    # a name that nothing is assigned to counts as a bare word of its own; give every name a value
    pairs += [(name, f"n{i}") for i, name in enumerate(NAMES)]
    rng.shuffle(pairs)
    text = "".join(f"{name} = {value}\n" if value in NAMES else f'{name} = "{value}"\n' for name, value in pairs)
    found = {text[start:end]: score for start, end, _, score in secret_scan.secrets_by_flow(text.encode())}
    assert found == slow_flow(pairs)


@pytest.mark.parametrize(
    "page",
    [
        lambda n: b"password = [a, " * (n // 14), lambda n: b"password = x " + b'\\"' * (n // 2), lambda n: b"secret: value\nvalue: secret\n" * (n // 28),
        lambda n: b'secret = """ a\\"\n' * (n // 17), lambda n: b"secret = '\\'\n" * (n // 13), lambda n: b"secret = (" * (n // 10),
        lambda n: b"".join(b"a%d = a%d\n" % (i, i + 1) for i in range(n // 14)) + b"password = a0\n", lambda n: b"password" + b" " * n,
        lambda n: b"secret: |\n\n" * (n // 11), lambda n: b'token = " x\n' * (n // 12),
    ],
)
def test_time_grows_with_the_text(page):
    def seconds(n):
        best = []
        for _ in range(2):
            started = time.process_time()
            secret_scan.found(page(n))
            best.append(time.process_time() - started)
        return min(best)

    assert seconds(400_000) < 3.5 * seconds(200_000) + 0.05
    assert seconds(1_000_000) < 5
