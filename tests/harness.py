"""Drives a stateful processor for one key, with the clock in the test's hands."""

import pandas as pd


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = tuple(value)

    def clear(self):
        self.value = None


class _List:
    def __init__(self):
        self.rows = []

    def get(self):
        return iter(list(self.rows))

    def appendList(self, rows):
        self.rows.extend(rows)

    def put(self, rows):
        self.rows = list(rows)

    def clear(self):
        self.rows = []


class _Map:
    def __init__(self):
        self.rows = {}

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, value):
        self.rows[key] = tuple(value)

    def removeKey(self, key):
        del self.rows[key]

    def iterator(self):
        return iter(list(self.rows.items()))

    def clear(self):
        self.rows = {}


class Harness:
    """Also the handle and the timer values that the processor sees."""

    def __init__(self, processor, key="1"):
        self.processor, self.key, self.now, self.timers = processor, (key,), 0, set()
        self.output = []
        processor.init(self)

    def getValueState(self, name, schema, ttl=None):
        return _Value()

    def getListState(self, name, schema, ttl=None):
        return _List()

    def getMapState(self, name, key, value, ttl=None):
        return _Map()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def listTimers(self):
        return iter(sorted(self.timers))

    def getCurrentProcessingTimeInMs(self):
        return self.now

    getCurrentWatermarkInMs = getCurrentProcessingTimeInMs

    def _take(self, frames):
        for frame in frames:
            self.output.extend(frame.itertuples(index=False, name=None))

    def send(self, *rows, columns):
        self._take(self.processor.handleInputRows(
            self.key, iter([pd.DataFrame(rows, columns=columns)]), self))

    def clock(self, now):
        """Move processing time or the watermark forward and fire due timers."""
        self.now = now
        for at in [t for t in sorted(self.timers) if t <= now]:
            self.timers.discard(at)
            self._take(self.processor.handleExpiredTimer(self.key, self, None))
        return self.output
