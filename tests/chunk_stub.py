"""A DB-API cursor over a list of rows, for the chunked source; understands the few texts that it sends."""

import datetime as dt
import os
import re

ROWS = [(i, f"n{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), None if i % 10 == 3 else i * 0.5) for i in range(2_000)]
NAMES = ["id", "name", "at", "value"]


def log(line):
    """Every statement and fetch, in a file that all processes of a test share."""
    path = os.environ.get("CHUNK_STUB_LOG")
    if path:
        with open(path, "a") as f:
            f.write(line + "\n")


class Cursor:
    arraysize = 1

    def execute(self, sql, values=()):
        log(f"{sql} {values}")
        select, _, where = re.fullmatch(r"SELECT (.*?) FROM \((.*?)\) q(?: WHERE (.*))?", sql).groups()
        values, rows = list(values), list(ROWS)
        for part in (where.split(" AND ") if where else []):
            options = part.strip("()").split(" OR ")
            tests = []
            for o in options:
                column, sign = re.fullmatch(r"(\w+) (IS NOT NULL|IS NULL|IN|>=|<=|=|>|<).*", o).groups()
                n = o.count("?")
                tests.append((NAMES.index(column), sign, values[:n]))
                del values[:n]
            rows = [r for r in rows if any(self.holds(r[c], s, v) for c, s, v in tests)]
        if select.startswith("MIN"):
            c = NAMES.index(re.match(r"MIN\((\w+)\)", select)[1])
            held = [r[c] for r in rows if r[c] is not None]
            self.rows = [(min(held), max(held)) if held else (None, None)]
        else:
            at = [NAMES.index(c) for c in select.split(", ")]
            self.rows = [tuple(r[c] for c in at) for r in rows]

    @staticmethod
    def holds(x, sign, v):
        if sign.startswith("IS"):
            return (x is None) == (sign == "IS NULL")
        return x is not None and {"=": lambda: x == v[0], ">=": lambda: x >= v[0], "<=": lambda: x <= v[0], ">": lambda: x > v[0], "<": lambda: x < v[0], "IN": lambda: x in v}[sign]()

    def fetchone(self):
        return self.rows[0]

    def fetchmany(self, n):
        out, self.rows = self.rows[:n], self.rows[n:]
        log(f"fetched {len(out)}")
        return out


class Connection:
    def cursor(self):
        return Cursor()

    def close(self):
        log("closed")


def connect():
    return Connection()
