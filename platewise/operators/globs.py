"""Many file-name globs at once: the patterns of a folder as one automaton that every file name walks once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.functions.text import base_name, parent_dir
from platewise.session import broadcast_if_small, checkpointed

#: Patterns of an automaton, file names that meet one automaton in a task, and states that are kept.
BLOCK, NAMES, STATES = 20_000, 200_000, 50_000
ANY, STAR = "?", "*"


def tokens(pattern: str) -> list:
    """A glob as characters, ``ANY``, ``STAR`` and character classes (wanted or not, characters, ranges); an unclosed bracket is a character."""
    out, at = [], 0
    while at < len(pattern):
        c, at = pattern[at], at + 1
        if c == "*":
            if not out or out[-1] != (STAR,):
                out.append((STAR,))
        elif c == "?":
            out.append((ANY,))
        elif c == "[":
            begin = at + (pattern[at:at + 1] == "!")
            close = pattern.find("]", begin + (pattern[begin:begin + 1] == "]"))
            if close < 0:
                out.append(c)
                continue
            body, single, ranges, k = pattern[begin:close], [], [], 0
            while k < len(body):
                if k + 2 < len(body) and body[k + 1] == "-":
                    ranges.append((body[k], body[k + 2]))
                    k += 3
                else:
                    single.append(body[k])
                    k += 1
            out.append((begin == at, frozenset(single), tuple(ranges)))
            at = close + 1
        else:
            out.append(c)
    return out


class PatternAutomaton:
    """The tokens of all patterns as a tree, walked as a deterministic automaton that is built as names need it.

    A state is the set of places in the tree that the characters so far can lead to; a name costs one look-up per character once its states are known.
    Patterns that share their beginning share its places, whatever wildcards it has. At most ``states`` states are kept.
    """

    def __init__(self, patterns: list[str], states: int = STATES):
        self.most = states
        self.letters: list[dict[str, int]] = [{}]
        self.others: list[list[tuple]] = [[]]
        self.star: list[int] = [-1]
        self.loops: list[bool] = [False]
        self.ends: list[list[int]] = [[]]
        for number, pattern in enumerate(patterns):
            node = 0
            for token in tokens(pattern):
                node = self._child(node, token)
            self.ends[node].append(number)
        self._forget()

    def _child(self, node: int, token) -> int:
        if token == (STAR,):
            if self.star[node] < 0:
                self.star[node] = self._new(True)
            return self.star[node]
        if isinstance(token, str):
            if token not in self.letters[node]:
                self.letters[node][token] = self._new(False)
            return self.letters[node][token]
        for known, child in self.others[node]:
            if known == token:
                return child
        self.others[node].append((token, self._new(False)))
        return self.others[node][-1][1]

    def _new(self, loop: bool) -> int:
        for column, value in ((self.letters, {}), (self.others, []), (self.star, -1), (self.loops, loop), (self.ends, [])):
            column.append(value)
        return len(self.loops) - 1

    def _forget(self) -> None:
        self.moves: list[dict[str, int]] = []
        self.places: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.accepts: list[list[int]] = []
        self.begin = self._state({0})

    def _state(self, places: set[int]) -> int:
        for node in list(places):
            while self.star[node] >= 0:  # a star may match nothing
                node = self.star[node]
                places.add(node)
        key = frozenset(places)
        if key not in self.number:
            self.number[key] = len(self.places)
            self.places.append(key)
            self.moves.append({})
            self.accepts.append([p for node in key for p in self.ends[node]])
        return self.number[key]

    def _step(self, state: int, char: str) -> int:
        reached = set()
        for node in self.places[state]:
            if self.loops[node]:
                reached.add(node)
            child = self.letters[node].get(char)
            if child is not None:
                reached.add(child)
            for token, child in self.others[node]:
                if token == (ANY,) or (char in token[1] or any(a <= char <= b for a, b in token[2])) == token[0]:
                    reached.add(child)
        found = self._state(reached)
        self.moves[state][char] = found
        return found

    def matches(self, name: str) -> list[int]:
        """Numbers of the patterns that fit the whole name."""
        if len(self.places) > self.most:
            self._forget()
        state = self.begin
        for char in name:
            following = self.moves[state].get(char)
            state = self._step(state, char) if following is None else following
        return self.accepts[state]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Patterns that some name fits, from rows sorted by (dir, salt, block, real): a group's patterns come before its names."""
    key, patterns, automaton, found = None, [], None, set()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([patterns[k] for k in sorted(found)], pa.string())], names=["pattern"])

    for batch in batches:
        for *group, name, real in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if group != key:
                if found:
                    yield out()
                key, patterns, automaton, found = group, [], None, set()
            if not real:
                patterns.append(name)
            elif len(found) < len(patterns):
                if automaton is None:
                    automaton = PatternAutomaton([p.rsplit("/", 1)[-1] for p in patterns])
                found.update(automaton.matches(name))
    if found:
        yield out()


def glob_match(patterns: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The distinct ``pattern`` values that at least one artifact path matches.

    Wildcards (``*``, ``?``, ``[...]``) are honoured in the last path component only. Patterns and files meet by folder. The patterns of a folder are
    cut into blocks of about ``BLOCK``, each one automaton that every file name of the folder walks once, so the time grows with the files and
    not with the pairs of files and patterns that agree somewhere. A folder with many files is salted: every ``NAMES`` of them
    meet a copy of its patterns in a group of their own.
    """
    wanted = checkpointed(patterns.select("pattern").distinct().withColumn("dir", parent_dir(F.col("pattern"))))
    folders = wanted.groupBy("dir").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    files = artifacts.select(parent_dir(F.col("path")).alias("dir"), base_name(F.col("path")).alias("name"))
    files = checkpointed(files.join(broadcast_if_small(folders), "dir"))
    salted = broadcast_if_small(files.groupBy("dir", "blocks").agg(F.ceil(F.count("*") / NAMES).cast("int").alias("salts")))

    def part(of: str, by: str) -> Column:
        return F.pmod(F.xxhash64(by, F.lit(of)), F.col(of).cast("long")).cast("int")

    walkers = files.join(salted.select("dir", "salts"), "dir").select(
        "dir", part("salts", "name").alias("salt"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "name", F.lit(True).alias("real"))
    trees = wanted.join(salted, "dir").select(
        "dir", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), part("blocks", "pattern").alias("block"), F.col("pattern").alias("name"), F.lit(False).alias("real"))
    group = ["dir", "salt", "block"]
    met = trees.unionByName(walkers).repartition(*group).sortWithinPartitions(*group, "real").mapInArrow(_walk, "pattern string")
    # A path without a slash has the folder ''; one below the root has it too, so patterns are kept whole.
    return met.select("pattern").distinct()
