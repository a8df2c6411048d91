"""State of one block while its events are applied one by one.

Matching with removal is sequential inside a block: which drivers are left depends on every
earlier match. This small helper holds that state inside a task; Spark does the partitioning,
ordering and shuffling.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

import numpy as np

from larkspur.functions import scoring


class Driver(NamedTuple):
    latitude: float
    longitude: float
    gender: str | None
    rating: float
    salary: float
    ts: int
    seq: int


class Move(NamedTuple):
    latitude: float
    longitude: float
    ts: int
    seq: int


class Match(NamedTuple):
    driver_id: int
    score: float


class Board:
    """Available drivers of a block, their last location updates and its last driver count.

    What scoring needs of the available drivers is kept as a dense table, one row per driver,
    so that a request is a few array operations.
    """

    def __init__(self, consume: bool = True, location_wins: bool = False) -> None:
        self.consume = consume
        self.location_wins = location_wins
        self.drivers: dict[int, Driver] = {}
        self.moves: dict[int, Move] = {}
        self.taken: set[int] = set()
        self.previous: int | None = None
        self._ids: list[int] = []
        self._row: dict[int, int] = {}
        self._gender_codes: dict[str | None, int] = {None: 0}
        # latitude, longitude, gender code, rating score, salary score
        self._table = np.empty((16, 5))

    def restore(self, drivers: Mapping[int, Driver], moves: Mapping[int, Move]) -> None:
        self.moves.update(moves)
        for driver_id, driver in drivers.items():
            self.put(driver_id, driver)

    def put(self, driver_id: int, driver: Driver) -> None:
        self.taken.discard(driver_id)
        self.drivers[driver_id] = driver
        row = self._row.get(driver_id)
        if row is None:
            row = self._row[driver_id] = len(self._ids)
            self._ids.append(driver_id)
            if row == len(self._table):
                self._table = np.concatenate([self._table, np.empty_like(self._table)])
        code = self._gender_codes.setdefault(driver.gender, len(self._gender_codes))
        self._table[row] = (
            *self.position(driver_id),
            code,
            driver.rating / scoring.MAX_RATING * scoring.RATING_WEIGHT,
            (1 - driver.salary / scoring.MAX_SALARY) * scoring.SALARY_WEIGHT,
        )

    def drop(self, driver_id: int) -> None:
        self.taken.discard(driver_id)
        self._remove(driver_id)

    def take(self, driver_id: int) -> None:
        """Remove a matched driver until it is put again."""
        self.taken.add(driver_id)
        self._remove(driver_id)

    def _remove(self, driver_id: int) -> None:
        if not self.location_wins:
            self.moves.pop(driver_id, None)
        if self.drivers.pop(driver_id, None) is None:
            return
        row, last = self._row.pop(driver_id), self._ids.pop()
        if last != driver_id:
            self._table[row] = self._table[len(self._ids)]
            self._ids[row], self._row[last] = last, row

    def move(self, driver_id: int, move: Move) -> None:
        """Remember a position; that of an absent driver counts only if location updates win."""
        present = driver_id in self.drivers
        if present or self.location_wins:
            self.moves[driver_id] = move
        if present:
            self._table[self._row[driver_id], :2] = self.position(driver_id)

    def count(self) -> int:
        return len(self.drivers)

    def surge(self) -> float:
        """Price factor of a request arriving now; remembers the count for the next one."""
        previous, self.previous = self.previous, self.count()
        if previous is None:
            return 1.0
        average = (previous + self.previous) / 2
        if average >= scoring.SURGE_BELOW:
            return 1.0
        return 1.0 + 2.0 * (scoring.SURGE_BELOW - average) / scoring.SURGE_STEP

    def position(self, driver_id: int) -> tuple[float, float]:
        driver, move = self.drivers[driver_id], self.moves.get(driver_id)
        if move and (self.location_wins or (move.ts, move.seq) > (driver.ts, driver.seq)):
            return move.latitude, move.longitude
        return driver.latitude, driver.longitude

    def request(self, latitude: float, longitude: float, preference: str | None) -> Match | None:
        """Best driver of positive score, ties to the first in text order; removed if consuming."""
        lat, lon, gender, rating, salary = self._table[: self.count()].T
        if preference is None:
            fits = np.zeros(len(gender), dtype=bool)
        elif preference == scoring.ANY_GENDER:
            fits = gender != 0
        else:
            fits = gender == self._gender_codes.get(preference, -1)
        distance = np.sqrt((lat - latitude) ** 2 + (lon - longitude) ** 2)
        scores = (
            np.exp(-distance) * scoring.DISTANCE_WEIGHT
            + fits * scoring.GENDER_WEIGHT
            + rating
            + salary
        )
        top = np.nanmax(scores, initial=0.0)
        if not top > 0:
            return None
        best = min((self._ids[i] for i in np.flatnonzero(scores == top)), key=str)
        if self.consume:
            self.take(best)
        return Match(best, float(top))
