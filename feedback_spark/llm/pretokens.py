"""White-space pre-tokens of a tokenizers file, and a bounded worker cache of their ids.

The tokenizers files used here never merge across white space: the normaliser
leaves white space alone (or folds it to one blank) and the splitting pattern
drops it.  A text is therefore its runs between ASCII white space, encoded one
by one; special strings inside a run are handled by the library itself.
"""

from __future__ import annotations

from collections.abc import Callable

#: Runs longer than this many bytes are encoded each time and never kept.
MAX_KEPT_BYTES = 64
#: Entries of one worker's cache; a full cache starts anew.
MAX_KEPT = 300_000


def read_file(path: str) -> str:
    """The tokenizer file's text (read on the driver, broadcast to the workers)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenizer_of(spec: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    return t


class Misses(dict):
    """Second tier: run -> ``value(run)``, filled on a miss, bounded."""

    def __init__(self, value: Callable[[bytes], object]):
        super().__init__()
        self.value = value

    def __missing__(self, run: bytes):
        got = self.value(run)
        if len(run) <= MAX_KEPT_BYTES:
            if len(self) >= MAX_KEPT:
                self.clear()
            self[run] = got
        return got


_WORKER: dict = {}


def worker_state(key: str, build: Callable[[], object]):
    """What a reused Python worker keeps between tasks; one state per kind."""
    kind = key.split(":", 1)[0]
    if _WORKER.get(kind, (None,))[0] != key:
        _WORKER[kind] = (key, build())
    return _WORKER[kind][1]
