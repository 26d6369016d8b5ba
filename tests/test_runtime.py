import pyarrow as pa

from custlens import runtime


def test_a_task_releases_memory_at_its_end(monkeypatch):
    """Rows pass unchanged; memory is released once, after the last one, and after an error too."""
    calls = []
    monkeypatch.setattr(runtime, "release_memory", lambda: calls.append(1))
    out = runtime.tidy(lambda batches: (2 * b for b in batches))(iter([1, 2]))
    assert next(out) == 2 and not calls
    assert list(out) == [4] and calls == [1]

    def broken(batches):
        raise ValueError
        yield

    try:
        list(runtime.tidy(broken)(iter([])))
    except ValueError:
        calls.append(2)
    assert calls == [1, 1, 2]


def test_release_memory_keeps_what_is_in_use():
    held = pa.array(range(1000))
    runtime.release_memory()
    assert held.to_pylist() == list(range(1000))
