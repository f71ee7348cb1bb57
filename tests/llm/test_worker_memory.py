"""What Python workers hold. Each case runs in a process of its own, so that nothing else counts."""

import subprocess
import sys
from pathlib import Path

import pytest

if not Path("/proc/self/smaps_rollup").exists():
    pytest.skip("memory can't be read here", allow_module_level=True)

HELD = """
import itertools, re
import numpy as np, pandas as pd
from pricetide.llm import bpe, words

def held():
    found = re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())
    return int(found[1]) / 1024
"""


def _run(code: str) -> list[float]:
    out = subprocess.run(
        [sys.executable, "-c", HELD + code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=120
    )
    assert out.returncode == 0, out.stderr
    return [float(x) for x in out.stdout.split()]


def test_ids_of_strings_seen_once_do_not_pile_up():
    # 260,000 different words, each of them once
    (grown,) = _run(r"""
ranks = b"\n".join(bpe.base64.b64encode(bytes([b])) + b" %d" % b for b in range(256))
encoder = bpe.Encoder(bpe.Vocabulary(ranks), r"\S+")
before, most = held(), 0
words_of = ("".join(x) for x in itertools.product("abcdefgh", repeat=6))
for _ in range(130):
    text = " ".join(itertools.islice(words_of, 2000))
    assert encoder.encode([text])[0] == np.frombuffer(text.replace(" ", "").encode(), np.uint8).astype("<u4").tobytes()
    most = max(most, held())
print(most - before)
""")
    assert grown < 25


def test_a_step_gives_back_what_its_batches_needed():
    # small blocks stay between large freed ones, as the rows of a batch do
    kept, result = _run(r"""
pinned = []
def pinning(batches):
    for n in batches:
        blocks = [bytearray(8000) for _ in range(n)]
        pinned.extend(blocks[::500])
        del blocks
        yield n
before = held()
got = list(words.lean(pinning)(iter([10_000, 10_000])))
print(held() - before, sum(got))
""")
    assert result == 20_000
    assert kept < 20


def test_lean_keeps_batches_and_annotations():
    from pricetide.llm.words import lean

    def doubled(batches: list) -> list:
        for x in batches:
            yield 2 * x

    assert list(lean(doubled)(iter([1, 2, 3]))) == [2, 4, 6]
    assert lean(doubled).__annotations__ == doubled.__annotations__
