import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wordsieve.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def compiled(monkeypatch):
    """Treat every word table as too large to inline, so that it becomes an automaton."""
    from wordsieve.operators import joins

    monkeypatch.setattr(joins, "INLINE_WORDS", 0)


@pytest.fixture
def split(monkeypatch):
    """The same, in several automata."""
    from wordsieve.operators import joins

    monkeypatch.setattr(joins, "INLINE_WORDS", 0)
    monkeypatch.setattr(joins, "AUTOMATON_CHARS", 12)
    monkeypatch.setattr(joins, "AUTOMATON_PARTS", 1000)


@pytest.fixture
def broadcast(monkeypatch):
    """Treat every word table as too large for an automaton."""
    from wordsieve.operators import joins

    monkeypatch.setattr(joins, "AUTOMATON_CHARS", 0)


@pytest.fixture
def shuffled(monkeypatch):
    """Treat every word table as too large to broadcast, to compile or to inline."""
    from wordsieve.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(joins, "INLINE_WORDS", 0)
    monkeypatch.setattr(joins, "AUTOMATON_CHARS", 0)
