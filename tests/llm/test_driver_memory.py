"""What training takes of the driver's memory is given back, also when it fails."""

import pytest

from tillroll.llm import toxicity


def test_training_gives_memory_back(monkeypatch):
    done = []
    monkeypatch.setattr(toxicity, "give_back", lambda: done.append(1))
    monkeypatch.setattr(toxicity, "_train", lambda *_: "model")
    assert toxicity.train(None, None) == "model" and done == [1]

    def die(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(toxicity, "_train", die)
    with pytest.raises(RuntimeError, match="lost"):
        toxicity.train(None, None)
    assert done == [1, 1]
