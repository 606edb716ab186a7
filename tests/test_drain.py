"""How long a query without an end is waited for."""

import pytest

from loomcart.catalog.streams import drain


class Query:
    """A query that shows its progress look by look, and remembers one batch only."""

    def __init__(self, *looks):
        self.looks, self.stopped, self.isActive = list(looks), False, True

    @property
    def recentProgress(self):
        batch = self.looks.pop(0) if self.looks else None
        return [{"batchId": batch[0], "numInputRows": batch[1]}] if batch else []

    def exception(self):
        return None

    def stop(self):
        self.stopped = True


def test_a_long_batch_is_waited_for():
    """Two looks without news last longer than the limit; the first batch is forgotten by then."""
    query = Query((0, 5), None, None, (1, 7))
    assert drain(query, 12, timeout=0.1) == 12 and query.stopped


def test_empty_batches_end_the_wait():
    query = Query((0, 5), (1, 0), (2, 0), (3, 0), (4, 7))
    with pytest.raises(TimeoutError):
        drain(query, 12, timeout=0.1)
    assert query.stopped
