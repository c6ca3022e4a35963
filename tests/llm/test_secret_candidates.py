"""The scan for candidates against a plain one, in linear time, and its features of long values."""

import math
import random
import time

import pytest

from velora.llm import secret_scan as module
from velora.llm.secret_scan import KEYED, NEXT_NAME, Dictionary, candidates, features


def plain_keyed(text):
    """Values after key words, each searched for on its own."""
    out, signs = [], list(KEYED.finditer(text))
    for m, following in zip(signs, [*signs[1:], None], strict=False):
        s, quote = m.end(), m.group(1)
        if out and s < out[-1][1]:
            continue
        line = text[s:].split("\n")[0]
        if quote and quote in line:
            e = s + line.index(quote)
        else:
            e = next((i for i in range(s, len(text)) if text[i].isspace() or text[i] in "\"'`<>"), len(text))
            if following and following.start() < e and (other := NEXT_NAME.search(text, s, following.start())):
                e = other.start()
            e = s + len(text[s:e].rstrip(".,;:)]}&"))
        if e > s:
            out.append((s, e))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_candidates_equal_a_plain_scan(seed):
    rng = random.Random(seed)
    pieces = ["password=", "secret: ", "token='", 'key="', "bearer ", "a&", "x9", "&", ";", ",", " ", "\n", "'", '"', "`", "<", "hunter2", "abcDEF123456", "==", "auth := ", "é", ")", "api_key=", "."]
    for _ in range(600):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40)))
        keyed = plain_keyed(text)
        want = sorted([*keyed, *((s, e) for s, e in module._runs(text) if not any(s < b and a < e for a, b in keyed))])
        assert list(candidates(text)) == want, text


@pytest.mark.parametrize("unit", ["password=hunter2x9&", "password='hunter2x9;", "token: a,", 'key="abc'])
def test_candidates_of_long_texts_in_linear_time(unit):
    text = unit * (6_000_000 // len(unit))
    start = time.time()
    assert sum(1 for _ in candidates(text)) >= 1
    assert time.time() - start < 30


def test_features_of_a_long_value():
    rng = random.Random(3)
    value = "".join(rng.choice("abcXYZ019+/é") for _ in range(600_000))
    text, none = f"password={value} end", Dictionary(module.np.empty(0, module.np.uint64))
    x = features([(text, 9, 9 + len(value))], none)[0]
    kinds = [module._kind(c) for c in value]
    entropy = -sum(value.count(c) / len(value) * math.log2(value.count(c) / len(value)) for c in set(value))
    assert abs(x[1] - entropy) < 1e-9 and x[2] == sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / (len(value) - 1)
    assert x[3:6].tolist() == [kinds.count(k) / len(value) for k in (0, 2, 3)]
