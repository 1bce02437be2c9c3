"""A client that behaves by rule."""

from docsheaf.operators.calls import CallError


def keyed_client():
    """Behaves by the number on the first line, modulo 4: succeeds; fails twice
    with a rate limit, then succeeds; always times out; is refused."""
    last = {"key": None, "tries": 0}

    def call(text: str) -> str:
        key = int(text.split("\n", 1)[0])
        last["tries"] = last["tries"] + 1 if last["key"] == key else 1
        last["key"] = key
        if key % 4 == 1 and last["tries"] <= 2:
            raise CallError("rate limit", "rate_limit", 429)
        if key % 4 == 2:
            raise CallError("request timeout", "timeout")
        if key % 4 == 3:
            raise CallError("bad request", "status", 400)
        return f"reply of {len(text)}"

    return call
