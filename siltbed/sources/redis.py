"""Redis streams and lists as a Spark Python Data Source (format ``siltbed_redis``).

Streams are read through a consumer group, replay-safe:
* the group is created at id 0 (``MKSTREAM``; an existing group is fine);
* a micro-batch covers up to ``batch_size`` entries after the last planned id of each stream key. That id is kept in Redis
  beside the group (``<key>:planned:<group>``), so a new reader on the same checkpoint plans on from where the last one
  ended, though the group itself only moves once a batch is known to have landed;
* with option ``drain`` a micro-batch covers everything up to the ids that were the last when the run began, as
  ``availableNow`` promises (that trigger asks for the end once): one run lands all, however small ``batch_size`` is;
* entries are read with ``XRANGE`` on executors, an input partition for each 1000 entries (more, if a batch would have over
  ``MOST_PARTITIONS``). The driver learns the ids that end the partitions, from a script that runs in Redis; entries don't pass it;
* ``commit()`` (after the batch has landed) moves the group to the batch end with
  ``XGROUP SETID``; nothing is acknowledged before the data is durable. Spark commits a batch when it plans the next one, so the
  last batch of a run is acknowledged by :func:`acknowledge`, or else by the next run.
Lists are destructive queues, so each trigger moves as many items as the streams leave of ``batch_size`` (lists in
key order, first non-empty key first; ``drain``: all that were there when the run began) into a per-group pending list, server side (a Lua
``LMOVE`` loop: items never pass through the driver); a micro-batch reads pending items by
index on executors and ``commit()`` trims them. A failed batch is read again.

Each row is ``kind, key, entry_seq, entry_id, arrival_ts, fields`` (fields map<string,binary>;
list items arrive as ``{"value": item}``). ``siltbed.sources.envelope.from_redis`` turns it
into the envelope. Read failures raise (the task retries and the query reports it) instead
of looking like an empty poll.

The client is pluggable: option ``client`` = ``module:function`` returning an object with
the operations of ``RedisOps``; by default a ``redis.Redis`` connection is wrapped.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "kind string, key string, entry_seq long, entry_id string, arrival_ts timestamp, fields map<string,binary>"
# Connection defaults.
DEFAULT_HOST = "localhost"
DEFAULT_PORT = 6379
DEFAULT_DB = 0
DEFAULT_BATCH_SIZE = 1000
PAGE = 1000  # entries or items of one input partition
MOST_PARTITIONS = 20_000  # of one key and batch; beyond it they hold more entries
MOVED = 10_000  # list items that one call moves


def _split(v: str | None) -> list[str]:
    return [x.strip() for x in (v or "").split(",") if x.strip()]


def entry_pair(entry_id: str) -> tuple[int, int]:
    """(ms, n) of a stream id ``<ms>-<n>``: the order of entries."""
    ms, _, n = entry_id.partition("-")
    return int(ms), int(n or 0)


def entry_seq(entry_id: str) -> int:
    """A number that rises with the id as long as a millisecond has fewer than 2^20 entries.

    It is the envelope's offset, for people to look at; reading compares the pairs, and ``entry_id`` keeps both parts.
    """
    ms, n = entry_pair(entry_id)
    return (ms << 20) + min(n, (1 << 20) - 1)


def id_time(entry_id: str) -> dt.datetime:
    return dt.datetime.fromtimestamp(int(entry_id.split("-")[0]) / 1000.0, tz=dt.timezone.utc)


class RedisOps:
    """The few Redis operations the source needs, over a redis-py client."""

    def __init__(self, client):
        self.c = client

    def ensure_group(self, key, group):
        try:
            self.c.xgroup_create(name=key, groupname=group, id="0", mkstream=True)
        except Exception as e:  # noqa: BLE001
            if "BUSYGROUP" not in str(e):
                raise

    def group_last_id(self, key, group):
        for g in self.c.xinfo_groups(key):
            name = g.get("name")
            name = name.decode() if isinstance(name, bytes) else name
            if name == group:
                v = g.get("last-delivered-id")
                return v.decode() if isinstance(v, bytes) else v
        return "0-0"

    def last_id(self, key):
        r = self.c.xrevrange(key, "+", "-", count=1)
        if not r:
            return "0-0"
        v = r[0][0]
        return v.decode() if isinstance(v, bytes) else v

    def xrange_after(self, key, after, until, count):
        r = self.c.xrange(key, f"({after}", until, count=count)
        return [((i.decode() if isinstance(i, bytes) else i),
                 {(k.decode() if isinstance(k, bytes) else k): v for k, v in f.items()}) for i, f in r]

    def set_group_id(self, key, group, entry_id):
        self.c.xgroup_setid(key, group, entry_id)

    # ends of the next pages of a stream, found by the server: the caller gets ids and counts, no entries
    PAGES_SCRIPT = (
        "local out, after = {}, ARGV[1] "
        "for i = 1, tonumber(ARGV[4]) do "
        "  local r = redis.call('XRANGE', KEYS[1], '(' .. after, ARGV[2], 'COUNT', ARGV[3]) "
        "  if #r == 0 then break end "
        "  after = r[#r][1] "
        "  out[#out + 1] = after "
        "  out[#out + 1] = #r "
        "  if #r < tonumber(ARGV[3]) then break end "
        "end "
        "return out")

    def page_ends(self, key, after, until, size, most):
        """(id of the last entry, number of entries) of up to ``most`` pages of ``size`` entries after an id, up to ``until``."""
        r = self.c.eval(self.PAGES_SCRIPT, 1, key, after, until, int(size), int(most))
        return [((i.decode() if isinstance(i, bytes) else i), int(n)) for i, n in zip(r[::2], r[1::2])]

    def length(self, key):
        return int(self.c.xlen(key))

    def list_length(self, key):
        return int(self.c.llen(key))

    def get_text(self, key):
        v = self.c.get(key)
        return v.decode() if isinstance(v, bytes) else v

    def set_text(self, key, value):
        self.c.set(key, value)

    # server-side move of up to n items and the count of all moved so far, in one atomic step
    # (items never travel through the driver)
    MOVE_SCRIPT = (
        "local moved = tonumber(redis.call('GET', KEYS[3]) or redis.call('GET', KEYS[4]) or '0') "
        "for i = 1, tonumber(ARGV[1]) do "
        "  if not redis.call('LMOVE', KEYS[1], KEYS[2], 'LEFT', 'RIGHT') then break end "
        "  moved = moved + 1 "
        "end "
        "redis.call('SET', KEYS[3], moved) "
        "return moved")

    def move_items(self, key, pending, n):
        """Move up to n items to the pending list; the count of items moved since the beginning."""
        return int(self.c.eval(self.MOVE_SCRIPT, 4, key, pending, pending + ":moved", pending + ":base", int(n)))

    # trim what a batch has read and move the base, in one atomic step: a crash can't lose or repeat items
    COMMIT_SCRIPT = (
        "local base = tonumber(redis.call('GET', KEYS[2]) or '0') "
        "local upto = tonumber(ARGV[1]) "
        "if upto > base then redis.call('LTRIM', KEYS[1], upto - base, -1) redis.call('SET', KEYS[2], upto) end "
        "return 1")

    def commit_items(self, pending, upto):
        self.c.eval(self.COMMIT_SCRIPT, 2, pending, pending + ":base", int(upto))

    def lrange(self, key, start, stop):
        return self.c.lrange(key, start, stop)

    def get_int(self, key):
        v = self.c.get(key)
        return int(v) if v is not None else 0


def default_client(options: dict):
    import redis  # gated: only needed against a real server

    return RedisOps(redis.Redis(host=options.get("host", DEFAULT_HOST), port=int(options.get("port", DEFAULT_PORT)),
                                db=int(options.get("db", DEFAULT_DB)), password=options.get("password")))


def make_client(options: dict):
    spec = options.get("client")
    if not spec:
        return default_client(options)
    mod, _, fn = spec.partition(":")
    return getattr(importlib.import_module(mod), fn)(options)


class _Part(InputPartition):
    def __init__(self, kind, key, start, end):
        self.kind, self.key, self.start, self.end = kind, key, start, end


class RedisStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.streams = _split(options.get("stream_keys"))
        self.lists = _split(options.get("list_keys"))
        self.group = options.get("consumer_group")
        self.batch_size = int(options.get("batch_size", DEFAULT_BATCH_SIZE))
        if self.streams and not self.group:
            raise ValueError("consumer_group is required when stream_keys are set")
        if not self.streams and not self.lists:
            raise ValueError("give stream_keys and/or list_keys")
        self.drain = str(options.get("drain", "false")).lower() == "true"
        self._target: dict | None = None
        ops = make_client(self.options)
        for k in self.streams:
            ops.ensure_group(k, self.group)

    def _pending(self, key):
        return f"{key}:pending:{self.group or 'lists'}"

    def _planned(self, ops, key):
        """The end of what has been planned so far, by this reader or one before; never behind the group."""
        return max(ops.get_text(f"{key}:planned:{self.group}") or "0-0", ops.group_last_id(key, self.group), key=entry_pair)

    def _moved(self, ops, key):
        return max(ops.get_int(self._pending(key) + ":moved"), ops.get_int(self._pending(key) + ":base"))

    def initialOffset(self):
        ops = make_client(self.options)
        return {"streams": {k: ops.group_last_id(k, self.group) for k in self.streams},
                "lists": {k: ops.get_int(self._pending(k) + ":base") for k in self.lists}}

    def latestOffset(self):
        """Up to ``batch_size`` entries of each stream; the lists share what the streams leave of ``batch_size``.

        A stream's end is the id of its batch_size-th entry after the last planned one (an XRANGE with COUNT); a list's
        items are moved to its pending list, first non-empty key first, as a blocking pop over the keys would.
        """
        ops = make_client(self.options)
        if self.drain:
            return self._drained(ops)
        streams, left = {}, self.batch_size
        for k in self.streams:
            after = self._planned(ops, k)
            page = ops.page_ends(k, after, "+", self.batch_size, 1)
            streams[k] = page[0][0] if page else after
            if page:
                ops.set_text(f"{k}:planned:{self.group}", streams[k])
                left -= page[0][1]
        lists = {}
        for k in self.lists:
            was = self._moved(ops, k)
            lists[k] = ops.move_items(k, self._pending(k), left) if left > 0 else was
            left -= lists[k] - was
        return {"streams": streams, "lists": lists}

    def _drained(self, ops):
        """The same end whenever it is asked: the last ids, and the items there, when it was first asked."""
        if self._target is None:
            streams = {k: max(ops.last_id(k), self._planned(ops, k), key=entry_pair) for k in self.streams}
            lists = {}
            for k in self.lists:
                lists[k] = self._moved(ops, k)
                upto = lists[k] + ops.list_length(k)
                while lists[k] < upto:
                    now = ops.move_items(k, self._pending(k), min(MOVED, upto - lists[k]))
                    if now == lists[k]:
                        break
                    lists[k] = now
            for k, e in streams.items():
                ops.set_text(f"{k}:planned:{self.group}", e)
            self._target = {"streams": streams, "lists": lists}
        return self._target

    def partitions(self, start, end):
        parts = []
        for k in self.streams:
            a, b = start["streams"].get(k, "0-0"), end["streams"].get(k, "0-0")
            if entry_pair(b) > entry_pair(a):
                parts += self._split_stream(k, a, b)
        for k in self.lists:
            a, b = int(start["lists"].get(k, 0)), int(end["lists"].get(k, 0))
            size = max(PAGE, -(-(b - a) // MOST_PARTITIONS))
            parts += [_Part("list", k, at, min(at + size, b)) for at in range(a, b, size)]
        return parts

    def _split_stream(self, key, start, end):
        """Partitions of a page or more each, so that a hot stream is read by many tasks."""
        ops = make_client(self.options)
        size = max(PAGE, -(-ops.length(key) // MOST_PARTITIONS))
        parts = []
        while entry_pair(start) < entry_pair(end):
            pages = ops.page_ends(key, start, end, size, max(1, 100_000 // size))  # each call goes over some 100,000 entries
            for stop, _ in pages:
                parts.append(_Part("stream", key, start, stop))
                start = stop
            if not pages:  # what is left was deleted from the stream
                break
        return parts

    def read(self, p):
        ops = make_client(self.options)
        if p.kind == "stream":
            after = p.start
            while True:
                page = ops.xrange_after(p.key, after, p.end, self.batch_size)
                for eid, fields in page:
                    yield ("redis_stream", p.key, entry_seq(eid), eid, id_time(eid), fields)
                if len(page) < self.batch_size:
                    break
                after = page[-1][0]
        else:
            base = ops.get_int(self._pending(p.key) + ":base")
            now = dt.datetime.now(dt.timezone.utc)  # items carry no time: their arrival is the read
            for at in range(p.start, p.end, PAGE):
                items = ops.lrange(self._pending(p.key), at - base, min(at + PAGE, p.end) - base - 1)
                for i, item in enumerate(items):
                    yield ("redis_list", p.key, at + i, str(at + i), now, {"value": item})

    def commit(self, end):
        ops = make_client(self.options)
        for k in self.streams:
            e = end["streams"].get(k)
            if e and entry_pair(e) > entry_pair(ops.group_last_id(k, self.group)):
                ops.set_group_id(k, self.group, e)
        for k in self.lists:
            ops.commit_items(self._pending(k), int(end["lists"].get(k, 0)))


class RedisBatchReader(DataSourceReader):
    """Bounded read of what is there now (streams from the start, lists without removing)."""

    def __init__(self, options: dict):
        self.options = dict(options)
        self.streams = _split(options.get("stream_keys"))
        self.lists = _split(options.get("list_keys"))
        self.batch_size = int(options.get("batch_size", DEFAULT_BATCH_SIZE))

    def partitions(self):
        return [_Part("stream", k, "0-0", "+") for k in self.streams] + [_Part("list", k, 0, -1) for k in self.lists]

    def read(self, p):
        ops = make_client(self.options)
        if p.kind == "stream":
            after = "0-0"
            while True:
                page = ops.xrange_after(p.key, after, "+", self.batch_size)
                for eid, fields in page:
                    yield ("redis_stream", p.key, entry_seq(eid), eid, id_time(eid), fields)
                if len(page) < self.batch_size:
                    break
                after = page[-1][0]
        else:
            now, at = dt.datetime.now(dt.timezone.utc), 0
            while items := ops.lrange(p.key, at, at + PAGE - 1):  # a page at a time, never the whole list
                for i, item in enumerate(items):
                    yield ("redis_list", p.key, at + i, str(at + i), now, {"value": item})
                at += len(items)


class RedisDataSource(DataSource):
    @classmethod
    def name(cls):
        return "siltbed_redis"

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return RedisStreamReader(self.options)

    def reader(self, schema):
        return RedisBatchReader(self.options)


def acknowledge(options: dict, end: dict | str) -> None:
    """Move the groups to ``end`` and trim the pending lists: for the last batch of a run, once it has landed.

    ``end``: that batch's end offset, as JSON or not. It is safe to repeat: neither goes back.
    """
    reader = RedisStreamReader({**options, "drain": "false"})
    reader.commit(json.loads(end) if isinstance(end, str) else end)


def register(spark) -> None:
    spark.dataSource.register(RedisDataSource)
