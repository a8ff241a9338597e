import pytest

from filigree import __main__ as cli
from filigree import config
from filigree.sources.throttle import Bucket, retried, throttled


def test_layers_and_checks():
    c = config.load({"chunking": {"max_tokens": 300}}, {"chunking": {"min_tokens": 20}, "quality": {"strict": True}}, {"FILIGREE_CHUNKING__MAX_TOKENS": "256", "FILIGREE_QUALITY__STRICT": "no", "HOME": "x"})
    assert (c.chunking.max_tokens, c.chunking.min_tokens, c.chunking.overlap_tokens, c.quality.strict) == (256, 20, 50, False)
    for bad in ({"chunking": {"overlap_tokens": 600}}, {"chunking": {"nothing": 1}}, {"nothing": {}}, {"requests": {"burst": 0}}, {"chunking": {"max_tokens": "many"}}, {"quality": {"balance_tolerance": 0.5}}):
        with pytest.raises(config.ConfigError):
            config.load(bad, environ={})


def test_bucket_holds_the_rate():
    now = [0.0]
    bucket = Bucket(2.0, burst=2, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(10):
        bucket.take()
    assert abs(now[0] - 4.0) < 1e-9
    bucket.slow_down(3.0)
    assert bucket.rate == 1.0 and abs(now[0] - 7.0) < 1e-9
    for _ in range(20):
        bucket.succeeded()
    assert bucket.rate == 2.0


def test_retries():
    waits, left = [], [2]

    def call():
        if left[0]:
            left[0] -= 1
            raise OSError
        return "done"

    assert retried(call, sleep=waits.append) == "done" and waits == [1.0, 2.0]
    with pytest.raises(KeyError):
        retried(lambda: {}["x"], sleep=waits.append)
    assert list(throttled([1, 2], lambda x: x * 2, 1000, 4)) == [2, 4]


def test_command_line(capsys):
    assert cli.main(["list"]) == 0 and "jn_key_financials" in capsys.readouterr().out
    assert cli.main(["run"]) == 2
