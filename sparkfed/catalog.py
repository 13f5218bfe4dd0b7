"""Servers, user mappings and tables with declared columns, their options, and how options resolve."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from .types import spark_type


class OptionError(ValueError):
    pass


def _bool(name: str, v: str) -> bool:
    known = {"true": True, "on": True, "yes": True, "1": True, "false": False, "off": False, "no": False, "0": False}
    if str(v).lower() not in known:
        raise OptionError(f"{name} requires a Boolean value")
    return known[str(v).lower()]


def _whole(low: int, high: int, message: str) -> Callable[[str, str], int]:
    def check(name: str, v: str) -> int:
        try:
            n = int(v)
        except ValueError:
            n = low - 1
        if not low <= n <= high:
            raise OptionError(message.format(name=name))
        return n

    return check


def _one_of(*values: str) -> Callable[[str, str], str]:
    def check(name: str, v: str) -> str:
        if v.lower() not in values:
            raise OptionError(f'invalid option "{v}" for {name}; valid: {", ".join(values)}')
        return v.lower()

    return check


def _text(name: str, v: str) -> str:
    return v


_timeout = _whole(1, 99_999, "{name} must be between 1 and 99999 seconds")
#: Option -> (where it may stand, default, check). query_timeout is accepted and has no effect.
OPTIONS: dict[str, tuple[tuple[str, ...], object, Callable]] = {
    "host": (("server",), "localhost", _text),
    "port": (("server",), 10000, _whole(1, 65_534, "invalid port number")),
    "client_type": (("server",), "hiveserver2", _one_of("hiveserver2", "spark")),
    "auth_type": (("server",), None, _one_of("nosasl", "ldap")),
    "use_remote_estimate": (("server",), False, _bool),
    "query_timeout": (("server",), 300, _timeout),
    "connect_timeout": (("server",), 300, _timeout),
    "fetch_size": (("server",), 10_000, _whole(1, 2**31 - 1, "{name} must be a positive number")),
    "log_remote_sql": (("server",), False, _bool),
    "enable_join_pushdown": (("server", "table"), True, _bool),
    "enable_aggregate_pushdown": (("server", "table"), True, _bool),
    "enable_order_by_pushdown": (("server", "table"), True, _bool),
    "ssl": (("server",), False, _bool),
    "usesystemtruststore": (("server",), None, _text),
    "ssltruststore": (("server",), None, _text),
    "truststorepassword": (("server",), None, _text),
    "username": (("user",), None, _text),
    "password": (("user",), None, _text),
    "dbname": (("table",), "default", _text),
    "table_name": (("table",), None, _text),
    # Where the data of a table lies, for sources that Spark opens itself.
    "format": (("table",), "table", _one_of("table", "parquet", "orc", "csv", "jdbc")),
    "location": (("table",), None, _text),
    "delimiter": (("table",), ",", _text),
    "collection_delimiter": (("table",), "$", _text),
    "null_text": (("table",), "NULL", _text),
    "empty_as_null": (("table",), True, _bool),
    # How a JDBC source is read in parallel: ranges of a number, date or timestamp at the source.
    "partition_column": (("table",), None, _text),
    "lower_bound": (("table",), None, _text),
    "upper_bound": (("table",), None, _text),
    "num_partitions": (("table",), None, _whole(1, 100_000, "{name} must be between 1 and 100000")),
}


def validate(scope: str, options: dict[str, str]) -> dict[str, object]:
    out = {}
    for name, v in options.items():
        if name not in OPTIONS or scope not in OPTIONS[name][0]:
            valid = ", ".join(n for n, o in OPTIONS.items() if scope in o[0])
            raise OptionError(f'invalid option "{name}"; valid options for a {scope}: {valid}')
        out[name] = OPTIONS[name][2](name, str(v))
    return out


@dataclass
class Server:
    name: str
    options: dict = field(default_factory=dict)
    owner: str = "public"


@dataclass
class ForeignTable:
    """columns: (name, declared type), in declared order; remote: a column's name at the source, if another."""

    name: str
    server: str
    columns: list[tuple[str, str]]
    options: dict = field(default_factory=dict)
    remote: dict[str, str] = field(default_factory=dict)
    owner: str = "public"


class Catalog:
    def __init__(self) -> None:
        self.servers: dict[str, Server] = {}
        self.mappings: dict[tuple[str, str], dict] = {}
        self.tables: dict[str, ForeignTable] = {}

    def create_server(self, name: str, **options: str) -> Server:
        if name in self.servers:
            raise OptionError(f'server "{name}" already exists')
        self.servers[name] = Server(name, validate("server", options))
        return self.servers[name]

    def create_user_mapping(self, server: str, user: str = "public", **options: str) -> None:
        self._server(server)
        self.mappings[server, user] = validate("user", options)

    def create_table(self, name: str, server: str, columns: list[tuple[str, str]], remote: dict[str, str] | None = None, **options: str) -> ForeignTable:
        self._server(server)
        if name in self.tables:
            raise OptionError(f'relation "{name}" already exists')
        for _, declared in columns:
            spark_type(declared)
        self.tables[name] = ForeignTable(name, server, list(columns), validate("table", options), dict(remote or {}))
        return self.tables[name]

    def alter(self, scope: str, name: str, add: dict | None = None, set_: dict | None = None, drop: list[str] | None = None) -> None:
        """ALTER ... OPTIONS (ADD, SET, DROP) of a server or a table."""
        owner = self._server(name) if scope == "server" else self._table(name)
        owner.options = self._altered(scope, owner.options, add, set_, drop)

    def alter_user_mapping(self, server: str, user: str = "public", add: dict | None = None, set_: dict | None = None, drop: list[str] | None = None) -> None:
        self.mappings[server, user] = self._altered("user", self._mapping(server, user), add, set_, drop)

    def drop_user_mapping(self, server: str, user: str = "public") -> None:
        self._mapping(server, user)
        del self.mappings[server, user]

    def set_owner(self, scope: str, name: str, to: str) -> None:
        (self._server(name) if scope == "server" else self._table(name)).owner = to

    def rename_server(self, name: str, to: str) -> None:
        s = self._server(name)
        if to in self.servers:
            raise OptionError(f'server "{to}" already exists')
        self.servers[to] = replace(s, name=to)
        del self.servers[name]
        for t in self.tables.values():
            t.server = to if t.server == name else t.server
        self.mappings = {(to if n == name else n, user): o for (n, user), o in self.mappings.items()}

    @staticmethod
    def _altered(scope: str, options: dict, add: dict | None, set_: dict | None, drop: list[str] | None) -> dict:
        own = dict(options)
        for n in add or {}:
            if n in own:
                raise OptionError(f'option "{n}" provided more than once')
        for n in [*(set_ or {}), *(drop or [])]:
            if n not in own:
                raise OptionError(f'option "{n}" not found')
        own |= validate(scope, {**(add or {}), **(set_ or {})})
        return {k: v for k, v in own.items() if k not in (drop or [])}

    def rename_table(self, name: str, to: str) -> None:
        t = self._table(name)
        if to in self.tables:
            raise OptionError(f'relation "{to}" already exists')
        t.options.setdefault("table_name", name)
        self.tables[to] = replace(t, name=to)
        del self.tables[name]

    def drop_table(self, name: str) -> None:
        self._table(name)
        del self.tables[name]

    def drop_server(self, name: str, cascade: bool = False) -> None:
        self._server(name)
        held = [t.name for t in self.tables.values() if t.server == name]
        maps = [k for k in self.mappings if k[0] == name]
        if (held or maps) and not cascade:
            raise OptionError(f'cannot drop server "{name}" because other objects depend on it')
        for t in held:
            del self.tables[t]
        for k in maps:
            del self.mappings[k]
        del self.servers[name]

    def resolve(self, table: str, user: str = "public") -> dict[str, object]:
        """All options of a table: defaults, then the server's, the table's and the user mapping's; the last one wins."""
        t = self._table(table)
        out = {n: o[1] for n, o in OPTIONS.items()}
        out |= self._server(t.server).options | t.options | self.mappings.get((t.server, user), self.mappings.get((t.server, "public"), {}))
        out["table_name"] = out["table_name"] or t.name
        ranges = [out[n] is None for n in ("partition_column", "lower_bound", "upper_bound", "num_partitions")]
        if any(ranges) and not all(ranges):
            raise OptionError("partition_column, lower_bound, upper_bound and num_partitions are given together")
        if out["auth_type"] and not out["username"]:
            raise OptionError("a user name is required with auth_type")
        return out

    def _server(self, name: str) -> Server:
        if name not in self.servers:
            raise OptionError(f'server "{name}" does not exist')
        return self.servers[name]

    def _table(self, name: str) -> ForeignTable:
        if name not in self.tables:
            raise OptionError(f'relation "{name}" does not exist')
        return self.tables[name]

    def _mapping(self, server: str, user: str) -> dict:
        self._server(server)
        if (server, user) not in self.mappings:
            raise OptionError(f'user mapping for "{user}" does not exist for server "{server}"')
        return self.mappings[server, user]
