"""Length-prefixed packets: decoding at rest, and live from a TCP or UDP port.

A frame is a 4-byte big-endian length and JSON. A camera frame has, behind its JSON, an 8-byte
length and the bytes of the image. A length that isn't positive ends the connection.
"""

from __future__ import annotations

import select
import socket
import struct
import threading
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader


class Closed(ValueError):
    """A length that isn't positive: the sender is cut off."""


def packets(raw: bytes, *, images: bool = False) -> Iterator[tuple[str, bytes | None, int]]:
    """The frames of a byte string and where each ends; an unfinished one at the end is left out. Raises :class:`Closed`."""
    at = 0
    while at + 4 <= len(raw):
        (size,) = struct.unpack_from("!I", raw, at)
        if size == 0:
            raise Closed("a frame of no length")
        if at + 4 + size > len(raw):
            return
        text, end, image = raw[at + 4 : at + 4 + size], at + 4 + size, None
        if images:
            if end + 8 > len(raw):
                return
            (size,) = struct.unpack_from("!Q", raw, end)
            if end + 8 + size > len(raw):
                return
            image, end = raw[end + 8 : end + 8 + size], end + 8 + size
        at = end
        yield text.decode("utf-8", "replace"), image, at


def frames(raw: bytes, *, images: bool = False) -> Iterator[tuple[str, bytes | None]]:
    """The frames of a recorded byte string, up to a length that isn't positive."""
    try:
        for text, image, _ in packets(raw, images=images):
            yield text, image
    except Closed:
        return


def decode_frames(df: DataFrame, column: str, keys: list[str], *, images: bool = False) -> DataFrame:
    """Packets of byte strings in a column: keys, at, payload, data."""
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(batch.column(len(keys)).to_pylist()):
                rows = list(frames(raw or b"", images=images))
                own = [batch.column(c).take(pa.array([i] * len(rows), pa.int64())) for c in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(range(len(rows)), pa.int64()), pa.array([t for t, _ in rows], pa.string()), pa.array([d for _, d in rows], pa.binary())], names=[*keys, "at", "payload", "data"])

    return df.select(*keys, column).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keys) + ", at long, payload string, data binary")


def read_captures(spark: SparkSession, path: str, *, images: bool = False) -> DataFrame:
    """Packets of capture files (any store that Spark reads), one file a task: path, at, payload, data."""
    return decode_frames(spark.read.format("binaryFile").load(path).select("path", "content"), "content", ["path"], images=images)


class Ring:
    """A queue that keeps the newest packets: a full one drops its oldest. Packets are numbered as they come, dropped ones too."""

    def __init__(self, depth: int, first: int = 0):
        self.held: deque[tuple[int, str, bytes | None]] = deque()
        self.depth, self.next, self.dropped = depth, first, 0
        self.lock = threading.Lock()

    def put(self, text: str, image: bytes | None = None) -> None:
        with self.lock:
            if len(self.held) == self.depth:
                self.held.popleft()
                self.dropped += 1
            self.held.append((self.next, text, image))
            self.next += 1

    def take(self, most: int) -> list[tuple[int, int, str, bytes | None]]:
        """Up to ``most`` packets, oldest first, as number, how many were dropped before, text and image; they leave the ring."""
        with self.lock:
            taken = [self.held.popleft() for _ in range(max(0, min(most, len(self.held))))]
            return [(number, self.dropped, text, image) for number, text, image in taken]


class Port:
    """A thread that receives what comes to a port, TCP or UDP, into a ring."""

    def __init__(self, address: tuple[str, int], ring: Ring, *, udp: bool, images: bool):
        self.ring, self.udp, self.images = ring, udp, images
        self.socket = socket.socket(socket.AF_INET, socket.SOCK_DGRAM if udp else socket.SOCK_STREAM)
        self.socket.setsockopt(socket.SOL_SOCKET, socket.SO_REUSEADDR, 1)
        self.socket.bind(address)
        self.socket.setblocking(False)
        if not udp:
            self.socket.listen(8)
        self.clients: dict[socket.socket, bytearray] = {}
        self.closed = threading.Event()
        self.thread = threading.Thread(target=self._run, daemon=True)
        self.thread.start()

    def _run(self) -> None:
        while not self.closed.is_set():
            ready, _, _ = select.select([self.socket, *self.clients], [], [], 0.05)
            for one in ready:
                if one is not self.socket:
                    self._receive(one)
                elif self.udp:
                    self.ring.put(self.socket.recv(65535).decode("utf-8", "replace"))
                else:
                    self.clients[self.socket.accept()[0]] = bytearray()
        for one in (self.socket, *self.clients):
            one.close()

    def _receive(self, client: socket.socket) -> None:
        """Read what a client has sent, and take the whole frames out; a bad length, an error or an end closes it."""
        held, done = self.clients[client], 0
        try:
            got = client.recv(1 << 20)
            ended = not got
            held += got
            for text, image, done in packets(bytes(held), images=self.images):  # noqa: B007
                self.ring.put(text, image)
        except (Closed, OSError):
            ended = True
        del held[:done]
        if ended:
            client.close()
            del self.clients[client]

    def close(self) -> None:
        self.closed.set()
        self.thread.join(5)


def _row(packet: tuple[int, int, str, bytes | None], images: bool) -> tuple:
    number, dropped, text, image = packet
    return (number, text, dropped, image) if images else (number, text, dropped)


class _Reader(SimpleDataSourceStreamReader):
    """A port's packets; offsets are their numbers, so a batch can be read again until it is committed.

    What came between two triggers waits in a ring of ``queueDepth`` packets, and what a trigger took
    is held until its commit, so memory has a bound however fast senders are. What isn't committed
    lives in the process that holds the port: senders send again after a restart, and a batch that
    a lost process had read is refused rather than made up. :class:`PortsSource` keeps it.
    """

    def __init__(self, options: dict[str, str]):
        self.udp = options.get("protocol", "tcp") == "udp"
        self.images = options.get("images", "false") == "true"
        self.most = int(options.get("maxPacketsPerTrigger", "8"))
        self.address = (options.get("host", "127.0.0.1"), int(options["port"]))
        self.ring = Ring(int(options.get("queueDepth", "32")))
        self.port: Port | None = None
        self.taken: dict[int, tuple[int, int, str, bytes | None]] = {}
        self.seen, self.committed = 0, 0

    def __getstate__(self) -> dict:
        """What goes to tasks: the packets of open batches; the port stays with the process that holds it."""
        return {"taken": self.taken, "images": self.images, "seen": self.seen, "committed": self.committed}

    def initialOffset(self) -> dict:  # noqa: N802
        return {"n": 0}

    def _rows(self, start: int, end: int) -> Iterator[tuple]:
        if start < min(end, self.committed) or end > self.seen:
            raise RuntimeError(f"packets {start} to {end} were received by a process that is gone")
        return iter([_row(self.taken[n], self.images) for n in sorted(self.taken) if start <= n < end])

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if self.port is None:  # only the process that polls holds the port; Spark makes other readers that don't
            self.port = Port(self.address, self.ring, udp=self.udp, images=self.images)
        for packet in self.ring.take(self.most - sum(n >= start["n"] for n in self.taken)):
            self.taken[packet[0]] = packet
            self.seen = packet[0] + 1
        end = max(start["n"], self.seen)
        return self._rows(start["n"], end) if self.seen >= start["n"] else iter([]), {"n": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return self._rows(start["n"], end["n"])

    def commit(self, end: dict) -> None:
        self.committed = max(self.committed, end["n"])
        for n in [n for n in self.taken if n < end["n"]]:
            del self.taken[n]

    def close(self) -> None:
        if self.port is not None:
            self.port.close()


class FramedSource(DataSource):
    """``spark.readStream.format("framed")`` with ``port``, ``protocol`` (tcp, udp), ``host``, ``images``, ``maxPacketsPerTrigger``, ``queueDepth``."""

    @classmethod
    def name(cls) -> str:
        return "framed"

    def schema(self) -> str:
        return "ingest_seq long, payload string, dropped long" + (", data binary" if self.options.get("images", "false") == "true" else "")

    def simpleStreamReader(self, schema) -> _Reader:  # noqa: ANN001, N802
        return _Reader(dict(self.options))


class Captures:
    """Packets that ports received, in files that outlive the process: a folder a port, a file for each time they were taken.

    A file's name is the numbers that it covers; a file is whole as soon as it has its name.
    """

    HEAD = struct.Struct("!QQIq")

    def __init__(self, uri: str):
        self.files, self.root = fs.FileSystem.from_uri(uri)

    def spans(self, port: int) -> list[tuple[int, int, str]]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/{port}", allow_not_found=True))
        names = [(*map(int, f.base_name.removesuffix(".cap").split("-")), f.path) for f in found if f.base_name.endswith(".cap")]
        return sorted(names)

    def write(self, port: int, start: int, end: int, taken: list[tuple[int, int, str, bytes | None]]) -> None:
        self.files.create_dir(f"{self.root}/{port}")
        name = f"{self.root}/{port}/{start:020d}-{end:020d}"
        with self.files.open_output_stream(f"{name}.part") as out:
            for number, dropped, text, image in taken:
                raw = text.encode()
                out.write(self.HEAD.pack(number, dropped, len(raw), -1 if image is None else len(image)) + raw + (image or b""))
        self.files.move(f"{name}.part", f"{name}.cap")

    def read(self, path: str) -> Iterator[tuple[int, int, str, bytes | None]]:
        with self.files.open_input_stream(path) as held:
            while head := held.read(self.HEAD.size):
                number, dropped, text, image = self.HEAD.unpack(head)
                yield number, dropped, held.read(text).decode(), None if image < 0 else held.read(image)

    def drop(self, port: int, before: int) -> None:
        """Remove files of committed packets; the newest stays, for it says where numbers go on."""
        for _, end, path in self.spans(port)[:-1]:
            if end <= before:
                self.files.delete_file(path)


@dataclass
class _PortPart(InputPartition):
    port: int
    start: int
    end: int
    paths: list[str]


class _PortsReader(DataSourceStreamReader):
    """Several ports, a partition each. What a trigger takes is written before its offset is known, so batches can be read again by any process."""

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.numbers = [int(p) for p in options["ports"].split(",")]
        self.images = options.get("images", "false") == "true"
        self.ports: dict[int, Port] = {}
        self.done: dict[int, int] = {}

    def __getstate__(self) -> dict:
        return {"options": self.options, "numbers": self.numbers, "images": self.images, "ports": {}, "done": {}}

    @property
    def captures(self) -> Captures:
        return Captures(self.options["captures"])

    def initialOffset(self) -> dict:  # noqa: N802
        return {str(p): 0 for p in self.numbers}

    def _open(self) -> None:
        for p in self.numbers:
            held = self.captures.spans(p)
            self.done[p] = held[-1][1] if held else 0
            ring = Ring(int(self.options.get("queueDepth", "32")), self.done[p])
            self.ports[p] = Port((self.options.get("host", "127.0.0.1"), p), ring, udp=self.options.get("protocol", "tcp") == "udp", images=self.images)

    def latestOffset(self) -> dict:  # noqa: N802
        if not self.ports:
            self._open()
        for p, port in self.ports.items():
            if taken := port.ring.take(port.ring.depth):
                self.captures.write(p, self.done[p], taken[-1][0] + 1, taken)
                self.done[p] = taken[-1][0] + 1
        return {str(p): n for p, n in self.done.items()}

    def partitions(self, start: dict, end: dict) -> list[_PortPart]:
        parts = []
        for p in self.numbers:
            low, high = start.get(str(p), 0), end.get(str(p), 0)
            paths = [path for a, b, path in self.captures.spans(p) if a < high and b > low]
            parts.append(_PortPart(p, low, high, paths))
        return parts

    def read(self, partition: _PortPart) -> Iterator[tuple]:
        for path in partition.paths:
            for packet in self.captures.read(path):
                if partition.start <= packet[0] < partition.end:
                    yield (partition.port, *_row(packet, self.images))

    def commit(self, end: dict) -> None:
        for p in self.numbers:
            self.captures.drop(p, end.get(str(p), 0))

    def stop(self) -> None:
        for port in self.ports.values():
            port.close()


class PortsSource(DataSource):
    """``spark.readStream.format("framed_ports")`` with ``ports`` (by commas), ``captures`` (a folder that all share), ``protocol``, ``host``, ``images``, ``queueDepth``."""

    @classmethod
    def name(cls) -> str:
        return "framed_ports"

    def schema(self) -> str:
        return "port int, ingest_seq long, payload string, dropped long" + (", data binary" if self.options.get("images", "false") == "true" else "")

    def streamReader(self, schema) -> _PortsReader:  # noqa: ANN001, N802
        return _PortsReader(dict(self.options))
