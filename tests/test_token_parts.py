"""The token cache by files: right offsets, and only new or changed files are encoded."""

import json

from tokloom.sources import token_parts as T


def put(folder, name, chats):
    lines = [json.dumps({"conv_id": c, "conversations": [{"from": "human", "value": v}] if v is not None else []})
             for c, v in chats]
    (folder / name).write_text("\n".join(lines) + "\n")


def check(spark, folder, cache, merges=()):
    """All offsets follow from the files in path order; returns how many parts the cache has."""
    got = sorted((r["start"], r["n"], r["conv_id"], r["ids"]) for r in
                 T.cached_stream(spark, str(folder), str(cache), list(merges)).collect())
    assert [g[0] for g in got] == [sum(g[1] for g in got[:k]) for k in range(len(got))]
    assert all(len(ids) == n for _, n, _, ids in got)
    wanted = [r for f in sorted(folder.iterdir()) for r in sorted(
        (json.loads(line)["conv_id"] or -1) for line in f.read_text().splitlines())]
    assert [g[2] if g[2] is not None else -1 for g in got] == wanted
    return len(T.known_parts(spark, str(cache))), got


def test_only_new_files_are_encoded(spark, tmp_path, monkeypatch):
    folder, cache = tmp_path / "chats", tmp_path / "cache"
    folder.mkdir()
    put(folder, "a.json", [(3, "hello there"), (1, "hi"), (None, "nobody")])
    put(folder, "c.json", [(7, "x" * 50), (5, None)])
    encoded = []
    plain = T._encode
    monkeypatch.setattr(T, "_encode", lambda spark, missing, *more: (
        encoded.append(sorted(r["path"].rsplit("/", 1)[1] for r in missing)), plain(spark, missing, *more)))
    assert check(spark, folder, cache)[0] == 2
    put(folder, "b.json", [(2, "in between")])
    parts, before = check(spark, folder, cache)
    assert parts == 3
    assert check(spark, folder, cache) == (3, before)          # nothing new
    put(folder, "c.json", [(7, "other text"), (9, "y")])
    assert check(spark, folder, cache)[0] == 4                 # a changed file is a new part
    check(spark, folder, cache, [(104, 105, 256)])             # other merges: all of them
    assert encoded == [["a.json", "c.json"], ["b.json"], ["c.json"], ["a.json", "b.json", "c.json"]]


def test_an_unfinished_run_is_not_believed(spark, tmp_path, monkeypatch):
    folder, cache = tmp_path / "chats", tmp_path / "cache"
    folder.mkdir()
    put(folder, "a.json", [(1, "one"), (2, "two")])
    plain = T._encode

    def lost(*what):
        plain(*what)
        raise RuntimeError("lost")

    monkeypatch.setattr(T, "_encode", lost)
    try:
        T.cached_stream(spark, str(folder), str(cache), [])
    except RuntimeError:
        pass
    monkeypatch.setattr(T, "_encode", plain)
    assert T.known_parts(spark, str(cache)) == set()
    assert len(check(spark, folder, cache)[1]) == 2


def test_no_files(spark, tmp_path):
    (tmp_path / "chats").mkdir()
    assert T.cached_stream(spark, str(tmp_path / "chats"), str(tmp_path / "cache"), []).count() == 0

