"""Graph operators: impact closure, deploy stacks, ready frontier, waves, rollback stacks."""

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from cascadia import model as M
from cascadia.functions.lists import inline_lists
from cascadia.functions.ordered import numbered
from cascadia.functions.parts import PART, solved, split, strong_parts
from cascadia.functions.paths import with_prefixes
from cascadia.functions.placed import SALTS, Grown, along, dealt, named, reach, salted, stay
from cascadia.functions.text import empty_list, leaf, stable_hash, target_flags
from cascadia.model import BLOCKING, BROKEN, RUN_COLUMNS
from cascadia.operators.joins import (
    blocked_account_lists,
    cfg_blocked,
    reverse_deps,
    rollback_guard,
    run_deps,
    single_commit_scope,
    stack_semi,
    with_known_deps,
)
from cascadia.session import cut, kept, measured

_SCOPE = ["commit_id", "is_rollback"]


@dataclass(frozen=True)
class Stack:
    """New run rows, with their directory dependencies in long form.

    ``rows`` holds one narrow row per run, ``edges`` the dependencies under the same
    ``keys``; ``widen`` turns rows into run columns. A shared directory may have any number
    of dependents, so lists are only put into rows by :meth:`table`. They are whole there; who
    sets a limit takes the longer ones from :meth:`long_deps` with the same limit.

    Where ``paths`` (``at, dep_path``) is given, edges and lists hold the number ``at`` instead of a
    path, in the order of the list, and ``widen`` puts the paths into lists.
    """

    rows: DataFrame
    edges: DataFrame
    keys: tuple[str, ...]
    widen: Callable[[DataFrame], DataFrame]
    paths: DataFrame | None = None

    @property
    def runs(self) -> DataFrame:
        """Run columns except ``cfg_deps``."""
        return self.widen(self.rows).select([c for c in RUN_COLUMNS if c != "cfg_deps"])

    @property
    def deps(self) -> DataFrame:
        """All dependencies as ``execution_id, dep_path``."""
        return self._with_ids(self.edges)

    def table(self, limit: int | None = None) -> DataFrame:
        """Rows in table shape, with whole lists. One longer than a ``limit`` is NULL here, whole in long form."""
        order = "pos" if "pos" in self.edges.columns else None
        keys, value = list(self.keys), "dep_path" if self.paths is None else "at"
        lists = inline_lists(self.edges, keys, value, "cfg_deps", order, limit)
        none = F.array().cast(lists.schema["cfg_deps"].dataType)
        # The lists join the narrow rows; the long texts are made after the shuffle.
        # Numbers shrink so well in a shuffle that a part of little size may not fit into a hash table: merged.
        rows = self.rows if self.paths is None else self.rows.hint("merge")
        joined = rows.join(lists, keys, "left").withColumn(
            "cfg_deps", F.when(F.col("n").isNull(), none).otherwise(F.col("cfg_deps"))
        )
        return self.widen(joined).select(RUN_COLUMNS)

    def long_deps(self, limit: int | None = None) -> DataFrame:
        """``execution_id, dep_path`` of the lists that :meth:`table` leaves NULL."""
        keys = list(self.keys)
        long = self.edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        over = F.lit(False) if limit is None else F.col("n") > limit
        return self._with_ids(self.edges.join(long.filter(over), keys, "left_semi"))

    def _with_ids(self, edges: DataFrame) -> DataFrame:
        keys = list(self.keys)
        ids = self.widen(self.rows).select(*keys, "execution_id")
        named_edges = edges if self.paths is None else edges.join(self.paths.select("at", "dep_path"), "at")
        return named_edges.join(ids, keys).select("execution_id", "dep_path")


@dataclass(frozen=True)
class Closure:
    """Changed directories and all that depend on them, each once, as numbers; ``texts`` names them.

    ``rows`` is ``commit, node`` and lies by these; ``commits`` is ``commit_id, commit``, ``places``
    is ``graph_id, dir, node``.
    """

    rows: DataFrame
    commits: DataFrame
    places: DataFrame

    @property
    def texts(self) -> DataFrame:
        # Merged, so that the rows go on by commit and their names shrink in the next shuffle.
        return (
            self.rows.hint("merge").join(self.commits, "commit")
            .join(self.places, "node")
            .select("commit_id", "graph_id", F.col("dir").alias("cfg_path"))
        )


def impact_closure(
    nodes: DataFrame, edges: DataFrame, seeds: DataFrame, max_rounds: int | None = None
) -> DataFrame:
    """``commit_id, graph_id, cfg_path``: changed directories and all that depend on them.

    ``seeds`` is ``commit_id, graph_id, dir``. A changed directory that is no node is not
    returned, yet its dependents are.
    """
    return closure(nodes, edges, seeds, max_rounds).texts


def closure(
    nodes: DataFrame, edges: DataFrame, seeds: DataFrame, max_rounds: int | None = None
) -> Closure:
    """What :func:`impact_closure` returns, still as numbers.

    Each round moves only what the last one found: what was seen before lies by its key and stays
    there, so diamonds cost nothing and cycles end.
    """
    place = ["graph_id", "dir"]
    seeds = kept(seeds.select("commit_id", *place).distinct())
    commits = named(seeds.select("commit_id"), "commit")
    ends = [edges.select("graph_id", F.col(c).alias("dir"), F.lit(False).alias("known")) for c in ("dep_path", "cfg_path")]
    known = nodes.select("graph_id", F.col("cfg_path").alias("dir"), F.lit(True).alias("known"))
    places = known.unionByName(ends[0]).unionByName(ends[1]).groupBy(*place).agg(F.bool_or("known").alias("known"))
    places = named(places, "node")
    at = places.select(*place, "node")
    # An edge may lead to a directory that is null, from which none leads on; a commit may be null, too.
    to = at.select(F.col("graph_id").alias("_graph"), F.col("dir").alias("_dir"), F.col("node").alias("to_node"))
    up = (
        edges.select("graph_id", F.col("dep_path").alias("dir"), "cfg_path")
        .join(at, place)
        .join(to, (F.col("graph_id") == F.col("_graph")) & F.col("cfg_path").eqNullSafe(F.col("_dir")))
        .select("node", "to_node")
    )
    changed = seeds.join(commits.withColumnRenamed("commit_id", "_id"), F.col("commit_id").eqNullSafe(F.col("_id")))
    start = dealt(changed.select("commit", *place).join(places, place).select("commit", "node", "known"), ["commit", "node"])
    rounds = reach(start, kept(up.distinct()), ["commit", "node"], ["node"], max_rounds)
    # Whatever an edge leads to is a node, so only the seeds need the node check.
    result = Grown()
    for found in (start.filter("known").select("commit", "node"), *rounds[1:]):
        result.add(found)
    return Closure(result.frame, commits, at)


def peel(items: DataFrame, members: DataFrame, needs: DataFrame, first: DataFrame, max_rounds: int | None = None) -> list[DataFrame]:
    """Items in topological order, one frame of ``item`` a round.

    ``items`` has ``item`` for each that may come off; ``members`` is ``gate, item``; ``needs`` is
    ``item, gate``: an item waits until its gates are empty. The first round takes off the items
    that wait for nothing, and those of ``first``, which need not be among ``items``, leave their
    gates after it. Open gates of an item and members of a gate are counted once; a round
    subtracts what the last one took off, so each row is moved once, however many rounds follow.
    """
    needs = needs.select("item", "gate").distinct()
    if members.schema["gate"].dataType != LongType():
        gates = named(members.where("gate IS NOT NULL").select("gate"), "_gate")
        members, needs = (kept(df.join(gates, "gate").select("item", F.col("_gate").alias("gate"))) for df in (members, needs))
    size = members.groupBy("gate").agg(F.count(F.lit(1)).alias("n"))
    needs = kept(needs.join(size.select("gate"), "gate", "left_semi"))
    # The waiting items of a gate are spread, and an empty gate goes to each share of them.
    held = dealt(needs.withColumn("_salt", F.pmod(F.hash("item"), F.lit(SALTS))), ["gate", "_salt"])
    members = dealt(members, ["item"])
    gates, gate_log = stay(size.select("gate", F.col("n"), F.lit(False).alias("hit"))), Grown()
    waits = needs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    counts, count_log = stay(waits.select("item", "n", F.lit(False).alias("hit"))), Grown()
    items = dealt(items.select("item").distinct(), ["item"])
    free = stay(items.join(counts, "item", "left_anti"))
    first = dealt(first.select("item").distinct(), ["item"])
    rounds, off = [], stay(free.unionByName(first).distinct())
    while not off.isEmpty():
        if len(rounds) == max_rounds:
            raise RuntimeError(f"the waves did not end within {max_rounds} rounds")
        rounds.append(free)
        left = off.hint("shuffle_hash").join(members, "item").groupBy("gate").agg(F.count(F.lit(1)).alias("n"))
        empty = _used_up(left, gates, gate_log, "gate")
        copies = empty.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        opened = copies.hint("shuffle_hash").join(held, ["gate", "_salt"]).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
        ready = _used_up(opened, counts, count_log, "item")
        free = off = stay(ready.hint("shuffle_hash").join(items, "item", "left_semi"))
    return rounds


def _used_up(delta: DataFrame, totals: DataFrame, log: Grown, key: str) -> DataFrame:
    """Keys of ``delta`` whose total is now reached; ``delta`` joins the ``log``, the rest stays put."""
    delta = stay(delta.select(key, (-F.col("n")).alias("n"), F.lit(False).alias("hit")))
    touched = delta.select(key, F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("hit"))
    log.add(delta)
    rest = totals.unionByName(log.frame).unionByName(touched).groupBy(key)
    rest = rest.agg(F.sum("n").alias("n"), F.bool_or("hit").alias("hit"))
    return rest.filter(F.col("hit") & (F.col("n") == 0)).select(key)


def strong_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node on a cycle of the edges ``a -> b``; the greatest node names it.

    Nodes that lead to no cycle, or that none leads to, are peeled off. Then every node takes the
    greatest node that reaches it as its colour; those that reach back to the node they are
    named after, within its colour, are its component. What is left goes round again.
    """
    edges = kept(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct())
    if edges.schema["a"].dataType != LongType():
        # The rounds move numbers; the greatest node of a component is looked up at the end.
        names = named(edges.select(F.col("a").alias("name")).unionByName(edges.select(F.col("b").alias("name"))), "node")
        ends = edges.join(names.select(F.col("name").alias("a"), F.col("node").alias("_a")), "a")
        ends = ends.join(names.select(F.col("name").alias("b"), F.col("node").alias("_b")), "b")
        found = strong_components(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
        found = kept(found.join(names, "node").select("name", "component"))
        greatest = found.groupBy("component").agg(F.max("name").alias("greatest"))
        return found.join(greatest, "component").select(F.col("name").alias("node"), F.col("greatest").alias("component"))
    for source, target in (("a", "b"), ("b", "a")):
        needs = edges.select(F.col(source).alias("item"), F.col(target).alias("gate"))
        nodes = edges.select(F.col("a").alias("item")).unionByName(edges.select(F.col("b").alias("item"))).distinct()
        members = nodes.select(F.col("item").alias("gate"), "item")
        rounds = peel(nodes, members, needs, nodes.limit(0))
        if rounds:
            gone = Grown()
            for r in rounds:
                gone.add(r)
            edges = _without(edges, gone.frame.withColumnRenamed("item", "node"))
    out = Grown()
    while not edges.isEmpty():
        found = _one_colouring(edges)
        # A node alone is on a cycle only if it leads to itself.
        several = found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
        itself = edges.where("a = b").select(F.col("a").alias("node"))
        out.add(cut(found.join(several, "component", "left_semi").unionByName(found.join(itself, "node", "left_semi")).distinct()))
        edges = _without(edges, found.select("node"))
    empty = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return out.frame if out else empty


def _without(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between other nodes."""
    gone = cut(nodes)
    for end in ("a", "b"):
        edges = edges.join(gone.withColumnRenamed("node", end), end, "left_anti")
    return cut(edges.select("a", "b"))


def _one_colouring(edges: DataFrame) -> DataFrame:
    """The components that hold the greatest node that reaches them."""
    down = salted(edges.select(F.col("a").alias("node"), F.col("b").alias("to")), ["node"], 1)
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    colours = Grown()
    changed = stay(nodes.select("node", F.col("node").alias("colour")))
    while not changed.isEmpty():
        colours.add(changed)
        sent = along(changed, down, ["node"], F.col("colour"), 1).groupBy(F.col("to").alias("node")).agg(F.max("colour").alias("colour"))
        known = colours.frame.select("node", "colour", F.lit(True).alias("old"))
        best = sent.withColumn("old", F.lit(False)).unionByName(known).groupBy("node")
        best = best.agg(F.max("colour").alias("colour"), F.max(F.when(F.col("old"), F.col("colour"))).alias("before"))
        changed = stay(best.filter("colour > before").select("node", "colour"))
    colour = stay(colours.frame.groupBy("node").agg(F.max("colour").alias("colour")))
    ends = edges.join(colour.withColumnRenamed("node", "a"), "a").withColumnRenamed("colour", "colour_a")
    same = ends.join(colour.withColumnRenamed("node", "b"), "b").where("colour = colour_a")
    back = same.select(F.col("b").alias("node"), F.col("a").alias("to_node"))
    roots = colour.where("node = colour").select("node", F.col("node").alias("component"))
    # Edges of different colours are gone, so a node is reached from the root of its colour alone.
    rounds, found = reach(roots, back, ["component", "node"], ["node"]), Grown()
    for r in rounds:
        found.add(r)
    return cut(found.frame.select("node", "component"))


def cycle_members(edges: DataFrame, part: int = PART) -> DataFrame:
    """``graph_id, cfg_path, cycle`` of the directories on a dependency cycle.

    A directory that depends on a cycle or lies between two is on none. Those that reach each
    other share a ``cycle``, the greatest of them. A graph of up to ``part`` edges is solved in one
    task, larger ones in rounds.
    """
    edges = kept(edges.select("graph_id", "cfg_path", "dep_path").distinct())
    large = edges.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part)
    small, rest = split(edges, ["graph_id"], large)
    path = edges.schema["cfg_path"].dataType
    schema = StructType([edges.schema["graph_id"], StructField("cfg_path", path), StructField("cycle", path)])
    found = solved(small, ["graph_id"], schema, _cycles_of_graph)
    return found if rest is None else found.unionByName(_cycles_in_rounds(rest))


def _cycles_of_graph(rows: list[tuple]) -> Iterator[tuple]:
    names: dict = {}
    ends = [(names.setdefault(a, len(names)), names.setdefault(b, len(names))) for _, a, b in rows]
    out = [[] for _ in names]
    for a, b in ends:
        out[a].append(b)
    members = defaultdict(list)
    for name, component in zip(names, strong_parts(out)):
        members[component].append(name)
    for some in members.values():
        # A node alone is on a cycle only if it leads to itself.
        if len(some) > 1 or names[some[0]] in out[names[some[0]]]:
            greatest = max(some, key=lambda name: (name is not None, name))
            yield from ((rows[0][0], name, greatest) for name in some)


def _cycles_in_rounds(edges: DataFrame) -> DataFrame:
    node = lambda c: F.struct("graph_id", F.col(c).alias("cfg_path"))
    found = strong_components(edges.select(node("cfg_path").alias("a"), node("dep_path").alias("b")))
    return found.select("node.*", F.col("component.cfg_path").alias("cycle"))


def cyclic_dirs(edges: DataFrame) -> DataFrame:
    """Directories on a dependency cycle."""
    return cycle_members(edges).select("graph_id", "cfg_path")


def plan_scan_diff(plan_diff: DataFrame, dim: DataFrame) -> DataFrame:
    """Changed directories as the plan flags them, without closure, below their account's path."""
    accounts = dim.select(F.col("account_name").alias("graph_id"), F.col("account_path").alias("_above"))
    changed = plan_diff.filter(F.col("error").isNull()).select(
        "commit_id", "graph_id", "cfg_path"
    )
    return (
        with_prefixes(changed, F.col("cfg_path"))
        .join(accounts, ["graph_id", "_above"], "left_semi")
        .select("commit_id", "graph_id", "cfg_path")
        .distinct()
    )


def diff_paths(scan_type: str, **inputs: DataFrame) -> DataFrame:
    """The diff set of either change detection mode."""
    scans = {"graph": impact_closure, "plan": plan_scan_diff}
    if scan_type not in scans:
        raise ValueError(f"Scan type is invalid: {scan_type}")
    return scans[scan_type](**inputs)


def _run_id(kind: str) -> Column:
    # The suffix is a hash, so a retried task makes the same id; 48 bits keep directories with
    # equal leaves apart.
    return F.concat(
        F.lit(kind),
        F.col("pr_id").cast("string"),
        F.lit("-"),
        F.substring("commit_id", 1, 4),
        F.lit("-"),
        F.col("account_name"),
        F.lit("-"),
        leaf(F.col("cfg_path")),
        F.lit("-"),
        F.substring(stable_hash(F.lit(kind), F.col("commit_id"), F.col("cfg_path")), 1, 12),
    )


def _command(verb: str, role: str, tail: str, flags: Column | None = None) -> Column:
    parts = [
        F.lit(f"terragrunt {verb}{M.WORK_DIR_FLAG}"),
        F.col("cfg_path"),
        F.lit(M.ROLE_FLAG),
        F.col(role),
    ]
    return F.concat(*parts, *([] if flags is None else [flags]), F.lit(tail))


def deploy_stack(
    nodes: DataFrame,
    edges: DataFrame,
    diff: DataFrame | Closure,
    providers: DataFrame,
    dim: DataFrame,
    commits: DataFrame,
) -> Stack:
    """Deploy runs for every commit and account with changed directories.

    A graph's id is its account's name. ``commits`` is ``commit_id, pr_id, base_ref,
    head_ref``; ``providers`` is ``graph_id, cfg_path, new_providers``. A ``diff`` that is the
    :class:`Closure` of the same edges stays in numbers until its rows are made wide.
    """
    known = providers.select(
        F.col("graph_id").alias("account_name"), "cfg_path", "new_providers"
    )
    head = commits.select("commit_id", "pr_id", "base_ref", "head_ref")

    def widen(named_rows: DataFrame) -> DataFrame:
        return named_rows.join(dim, "account_name").withColumns(
            {
                "execution_id": _run_id(M.DEPLOY_ID),
                "is_rollback": F.lit(False),
                "status": F.lit("waiting"),
                "plan_command": _command("plan", "plan_role_arn", M.PLAN_TAIL),
                "apply_command": _command("apply", "apply_role_arn", M.APPLY_TAIL),
                "new_providers": F.coalesce(F.col("new_providers"), empty_list()),
                "new_resources": empty_list(),
                "approval_voters": empty_list(),
                "rejection_voters": empty_list(),
            }
        )

    place = ["account_name", "cfg_path"]
    if not isinstance(diff, Closure):
        found = stack_semi(
            *(df.withColumnRenamed("graph_id", "account_name") for df in (nodes, edges, diff)),
            graph="account_name",
        )
        named_rows = lambda rows: rows.join(known, place, "left").join(head, "commit_id")
        return Stack(found.rows, found.deps, ("commit_id", *place), lambda rows: widen(named_rows(rows)))

    at = diff.places.select(F.col("graph_id").alias("account_name"), F.col("dir").alias("cfg_path"), "node")
    below = at.select("account_name", F.col("cfg_path").alias("dep_path"), F.col("node").alias("dep"))
    shown = kept(at.join(nodes.withColumnRenamed("graph_id", "account_name"), place, "left_semi"))
    needs = edges.withColumnRenamed("graph_id", "account_name").join(shown, place).join(below, ["account_name", "dep_path"])
    # Numbered in the order of the lists: those of one directory follow each other.
    paths = kept(numbered(needs.select("node", "dep", "pos", "dep_path"), ["node", "pos", "dep_path"], "at"))
    # What depends on a changed directory is in the closure itself, so no edge has to be looked up there.
    found = diff.rows.withColumnRenamed("node", "dep").hint("merge").join(paths.select("dep", "node", "at"), "dep")

    def from_numbers(rows: DataFrame) -> DataFrame:
        info = shown.join(known, place, "left")
        if "cfg_deps" in rows.columns:
            pair = F.array_sort(F.collect_list(F.struct("at", "dep_path")))
            info = info.join(paths.groupBy("node").agg(F.min("at").alias("_first"), pair.getField("dep_path").alias("_paths")), "node", "left")
        # As in the closure, the rows go on by commit and the commits' texts shrink: so well that a part
        # that is measured to be small may not fit into a hash table, so this is merged as well.
        out = rows.hint("merge").join(diff.commits.join(head, "commit_id"), "commit").hint("merge").join(info, "node")
        if "cfg_deps" in rows.columns:
            path = lambda n: F.get("_paths", (n - F.col("_first")).cast("int"))
            out = out.withColumn("cfg_deps", F.transform("cfg_deps", path))
        return widen(out)

    return Stack(diff.rows, found.select("commit", "node", "at"), ("commit", "node"), from_numbers, paths)


def ready_frontier(
    runs: DataFrame, strict: bool = False, deps: DataFrame | None = None
) -> DataFrame:
    """``commit_id, is_rollback, execution_id`` of the waiting runs nothing blocks.

    Only direct dependencies count, and only ``succeeded`` unblocks. A NULL dependency
    list keeps its run out, unless ``deps`` (``execution_id, dep_path``) holds the list in
    long form. ``strict`` insists on a single waiting commit.
    """
    scope = single_commit_scope(runs, strict=True) if strict else runs
    # Four steps read these rows, of which nothing else counts, so the runs are made once.
    narrow = [*_SCOPE, "execution_id", "status", "cfg_path", "account_name", "account_deps"]
    if "cfg_deps" in runs.columns:
        narrow.append("cfg_deps")
    scope = kept(scope.filter(F.col("status").isin(*BLOCKING)).select(narrow))
    waiting = scope.filter((F.col("status") == "waiting") & F.col("account_deps").isNotNull())
    return (
        with_known_deps(waiting, deps)
        .select(*_SCOPE, "execution_id", "account_deps")
        .join(blocked_account_lists(scope), [*_SCOPE, "account_deps"], "left_anti")
        .join(cfg_blocked(scope, deps), "execution_id", "left_anti")
        .select(*_SCOPE, "execution_id")
    )


def _gate(kind: str, name: Column) -> Column:
    """What runs wait for: a directory or an account of their commit, while it has pending runs."""
    return F.struct(*_SCOPE, F.lit(kind).alias("kind"), name.alias("name"))


class Pending(NamedTuple):
    """Pending runs, the gates they keep open, and the gates that waiting ones wait for."""

    runs: DataFrame
    members: DataFrame
    needs: DataFrame


def pending_runs(runs: DataFrame, deps: DataFrame | None = None) -> Pending:
    """Pending runs (``item`` is the run's id) and the gates between them."""
    blocking = runs.filter(F.col("status").isin(*BLOCKING))
    unknown = F.col("cfg_deps").isNull() if "cfg_deps" in runs.columns else F.lit(False)
    if deps is not None:
        held = deps.select("execution_id", F.lit(True).alias("_held")).distinct()
        blocking = blocking.join(held, "execution_id", "left")
        unknown = unknown & F.col("_held").isNull()
    pending = kept(
        blocking.select(
            *_SCOPE, F.col("execution_id").alias("item"), "cfg_path", "account_name", "account_deps", "status",
            (F.col("account_deps").isNull() | unknown).alias("stuck"),
        )
    )
    both = F.array(_gate("dir", F.col("cfg_path")), _gate("account", F.col("account_name")))
    members = pending.select("item", F.explode(both).alias("gate")).where("gate.name IS NOT NULL")
    waiting = blocking.filter(F.col("status") == "waiting")
    by_dir = run_deps(waiting, deps).select(F.col("execution_id").alias("item"), _gate("dir", F.col("dep_path")).alias("gate"))
    accounts = pending.filter(F.col("status") == "waiting").select(*_SCOPE, "item", F.explode("account_deps").alias("name"))
    by_account = accounts.where("name IS NOT NULL").select("item", _gate("account", F.col("name")).alias("gate"))
    return Pending(pending, members, by_dir.unionByName(by_account))


def deploy_waves(
    runs: DataFrame, max_rounds: int | None = None, deps: DataFrame | None = None
) -> DataFrame:
    """``commit_id, execution_id, wave, blocked`` of every waiting run if all that start succeed.

    Wave 1 is the frontier now; what is running counts as done after wave 1. A run behind a
    failure or on a cycle never starts. Open dependencies are counted once, and a round
    subtracts what the last wave releases (see :func:`peel`).
    """
    return _waves(pending_runs(runs, deps), max_rounds)


def _waves(known: Pending, max_rounds: int | None = None) -> DataFrame:
    pending, members, needs = known
    able = pending.filter((F.col("status") == "waiting") & ~F.col("stuck"))
    rounds = peel(able.select("item"), members, needs, pending.filter("status = 'running'").select("item"), max_rounds)
    waves = Grown()
    for number, started in enumerate(rounds, 1):
        waves.add(started.select("item", F.lit(number).alias("wave")))
    waiting = pending.filter("status = 'waiting'").select("commit_id", "item")
    found = waiting.join(waves.frame, "item", "left") if rounds else waiting.withColumn("wave", F.lit(None).cast("int"))
    return found.select("commit_id", F.col("item").alias("execution_id"), "wave", F.col("wave").isNull().alias("blocked"))


_FLAGS = ["on_cycle", "behind_cycle", "behind_failure", "unknown"]


def blocked_reasons(runs: DataFrame, deps: DataFrame | None = None, part: int = PART) -> DataFrame:
    """Why waiting runs never start: ``commit_id, execution_id, on_cycle, behind_cycle, behind_failure, unknown``.

    A run is on a cycle if it waits, over other waiting runs, for itself; behind one if it waits
    for such a run without being one of the same cycle. It is behind a failure if it waits
    for a failed or aborted run. ``unknown`` tells that it has no known dependency list, or waits
    for one without. Runs wait within their commit alone, so a commit of up to ``part`` runs and
    dependencies is solved in one task. Larger ones are solved in rounds, as are those of a run without
    an id or with an id that stands for different runs.
    """
    narrow = [*_SCOPE, "execution_id", "status", "cfg_path", "account_name", "account_deps"]
    listed = "cfg_deps" in runs.columns
    blocking = kept(runs.filter(F.col("status").isin(*BLOCKING)).select(*narrow, *(["cfg_deps"] if listed else [])))
    waits = F.col("status") == "waiting"
    unknown, seen = F.col("cfg_deps").isNull() if listed else F.lit(False), blocking
    if deps is not None:
        seen = blocking.join(deps.select("execution_id", F.lit(True).alias("_held")).distinct(), "execution_id", "left")
        unknown = unknown & F.col("_held").isNull()
    rows = seen.select(
        *narrow[:-1],
        F.when(waits, F.col("account_deps")).alias("accounts"),
        (F.when(waits, F.col("cfg_deps")) if listed else F.lit(None).cast("array<string>")).alias("dirs"),
        (F.col("account_deps").isNull() | unknown).alias("stuck"),
    )
    same = F.xxhash64(*_SCOPE, "status", "stuck")
    ids = rows.groupBy("execution_id").agg(F.min(same).alias("low"), F.max(same).alias("high"))
    unsound = measured(ids.filter("low <> high OR execution_id IS NULL").select(F.col("execution_id").alias("_id")))
    odd = rows.join(unsound, F.col("execution_id").eqNullSafe(F.col("_id")), "left_semi").select(_SCOPE)
    if deps is not None:
        # The entries of long lists, as rows without a status.
        own = rows.filter(waits).select(*_SCOPE, "execution_id").distinct()
        long = deps.select("execution_id", "dep_path").join(own, "execution_id")
        none = {c: F.lit(None).cast(rows.schema[c].dataType) for c in ("status", "cfg_path", "account_name", "accounts", "stuck")}
        long = long.withColumns(none).withColumn("dirs", F.array("dep_path")).select(rows.columns)
        rows = kept(rows.unionByName(long))
    entries = F.lit(1) + F.greatest(F.size("accounts"), F.lit(0)) + F.greatest(F.size("dirs"), F.lit(0))
    large = rows.groupBy(*_SCOPE).agg(F.sum(entries).alias("n")).filter(F.col("n") > part).select(_SCOPE)
    odd = kept(odd.unionByName(large))
    small, rest = split(rows, _SCOPE, odd)
    schema = StructType([rows.schema["commit_id"], rows.schema["execution_id"], *[StructField(c, BooleanType()) for c in _FLAGS]])
    found = solved(small, _SCOPE, schema, _reasons_of_commit)
    return found if rest is None else found.unionByName(_reasons_in_rounds(split(blocking, _SCOPE, odd)[1], deps))


def _reasons_of_commit(rows: list[tuple]) -> Iterator[tuple]:
    copies, state, stuck = Counter(), {}, set()
    keeps, needs = defaultdict(set), defaultdict(set)
    for _, _, item, status, directory, account, accounts, dirs, unknown in rows:
        needs[item].update(("dir", d) for d in dirs or () if d is not None)
        needs[item].update(("account", a) for a in accounts or () if a is not None)
        if status is None:
            continue
        copies[item] += 1
        state[item] = status
        keeps[item].update(g for g in (("dir", directory), ("account", account)) if g[1] is not None)
        if unknown:
            stuck.add(item)
    members, waiters = Counter(g for i in state for g in keeps[i]), defaultdict(list)
    for i in state:
        needs[i] = {g for g in needs[i] if g in members}
        for g in needs[i]:
            waiters[g].append(i)
    waiting = [i for i in state if state[i] == "waiting"]
    left = {i: len(needs[i]) for i in waiting if i not in stuck}
    off = {i for i in state if state[i] == "running" or left.get(i) == 0}
    todo = list(off)
    while todo:
        for g in keeps[todo.pop()]:
            members[g] -= 1
            if members[g] == 0:
                for i in waiters[g]:
                    if i in left:
                        left[i] -= 1
                        if left[i] == 0:
                            off.add(i)
                            todo.append(i)
    stays = [i for i in waiting if i not in off]
    if not stays:
        return
    broken = [i for i in state if state[i] in BROKEN]
    nodes = {i: n for n, i in enumerate([*stays, *broken])}
    gates = {g: n for n, g in enumerate({g for i in nodes for g in keeps[i]}, len(nodes))}
    out = [[] for _ in range(len(nodes) + len(gates))]
    for i, n in nodes.items():
        out[n] = [gates[g] for g in keeps[i]]
        for g in needs[i]:
            if g in gates:
                out[gates[g]].append(n)
    part = strong_parts(out)
    together = defaultdict(list)
    for n, p in enumerate(part):
        together[p].append(n)
    failed, unlisted = {part[nodes[i]] for i in broken}, {part[nodes[i]] for i in stays if i in stuck}
    behind = set()
    # From those that none leads to on.
    for p in sorted(together, reverse=True):
        for to in {part[t] for n in together[p] for t in out[n]} - {p}:
            if len(together[p]) > 1 or p in behind:
                behind.add(to)
            for flag in (failed, unlisted):
                if p in flag:
                    flag.add(to)
    for i in stays:
        p = part[nodes[i]]
        # A run that comes several times meets itself, as in the joins of the rounds.
        yield from [(rows[0][0], i, len(together[p]) > 1, p in behind, p in failed, p in unlisted)] * copies[i] ** 2


def _reasons_in_rounds(runs: DataFrame, deps: DataFrame | None = None) -> DataFrame:
    known = pending_runs(runs, deps)
    pending, members, needs = known
    waves = _waves(known)
    stays = kept(waves.filter("blocked").select(F.col("execution_id").alias("item")))
    broken = pending.filter("status IN ('failed', 'aborted')").select("item")
    left = kept(stays.unionByName(broken).distinct())
    members = kept(members.join(left, "item", "left_semi"))
    needs = kept(needs.join(left, "item", "left_semi").join(members.select("gate").distinct(), "gate", "left_semi"))
    # A run and a gate it keeps open, and a gate and a run that waits for it, as one graph of numbers.
    runs_at = named(left, "id").withColumn("id", F.col("id") * 2)
    gates_at = named(members.select("gate"), "to_id").withColumn("to_id", F.col("to_id") * 2 + 1)

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.select("item", "gate").distinct().join(runs_at, "item").join(gates_at, "gate")

    opens = numbered(members).select(F.col("id").alias("node"), F.col("to_id").alias("to_node")).unionByName(
        numbered(needs).select(F.col("to_id").alias("node"), F.col("id").alias("to_node"))
    )
    opens = kept(opens)
    cycles = kept(strong_components(opens.select(F.col("node").alias("a"), F.col("to_node").alias("b"))))
    seeds = {"behind_failure": broken, "unknown": pending.filter("stuck AND status = 'waiting'").select("item")}
    flagged = stays
    for name, seed in seeds.items():
        hit = Grown()
        for r in reach(seed.join(runs_at, "item").select(F.col("id").alias("node")), opens, ["node"], ["node"]):
            hit.add(r)
        flagged = _flagged(flagged, hit.frame if hit else None, runs_at, name)
    # From each cycle on to what isn't on the same one: from where its edges leave it.
    own = cycles.select("node", F.col("component").alias("cycle"))
    leads = opens.join(own, "node").join(own.select(F.col("node").alias("to_node"), F.col("cycle").alias("to_cycle")), "to_node", "left")
    leaves = leads.filter("to_cycle IS NULL OR to_cycle <> cycle").select(F.col("to_node").alias("node"))
    hit = Grown()
    for r in reach(leaves, opens, ["node"], ["node"]):
        hit.add(r)
    flagged = _flagged(flagged, own, runs_at, "on_cycle")
    flagged = _flagged(flagged, hit.frame if hit else None, runs_at, "behind_cycle")
    flagged = flagged.join(pending.select("item", "commit_id"), "item")
    return flagged.select("commit_id", F.col("item").alias("execution_id"), *[F.coalesce(c, F.lit(False)).alias(c) for c in _FLAGS])


def _flagged(items: DataFrame, hit: DataFrame | None, runs_at: DataFrame, name: str) -> DataFrame:
    if hit is None:
        return items.withColumn(name, F.lit(False))
    found = hit.select(F.col("node").alias("id")).distinct().join(runs_at, "id").select("item")
    return items.join(found.withColumn(name, F.lit(True)), "item", "left")


def rollback_stack(
    runs: DataFrame, failed_commits: DataFrame, deps: DataFrame | None = None
) -> Stack:
    """Rollback runs, with reversed dependencies, for the failed commits that have none yet.

    Account dependencies are copied, not reversed. ``deps`` (``execution_id, dep_path``)
    holds the dependency lists of ``runs`` that are too long for a row.
    """
    failed = runs.join(failed_commits.select("commit_id").distinct(), "commit_id", "left_semi")
    # Rows, dependents and members all come from these runs, so they are stored once.
    created = kept(rollback_guard(failed).filter(F.size("new_resources") > 0))
    flags = target_flags(F.col("new_resources"))

    def widen(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "execution_id": _run_id(M.ROLLBACK_ID),
                "is_rollback": F.lit(True),
                "status": F.lit("waiting"),
                "plan_command": _command("plan", "plan_role_arn", M.DESTROY_PLAN_TAIL, flags),
                "apply_command": _command("destroy", "apply_role_arn", M.APPLY_TAIL, flags),
                "approval_voters": empty_list(),
                "rejection_voters": empty_list(),
            }
        )

    return Stack(
        created.drop("cfg_deps"), reverse_deps(created, deps), ("commit_id", "cfg_path"), widen
    )
