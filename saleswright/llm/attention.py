"""A small causal self-attention model over token classes, in numpy.

A sequence is cut into blocks of ``BLOCK`` tokens. Each token attends to its
own block up to itself and to the whole block before, so windows of two blocks
overlap by one and every token is scored once, with the keys and values of a
block worked out once for both windows it is in.

The next class is foretold in two steps: the group of ``SIDE`` classes that it is
in, and the class among those. The product is a probability over all classes, and
a token needs the weights of the groups and of its own group's classes only.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import prod

import numpy as np

BLOCK = 16
WIDTH = 16
HIDDEN = 32
SIDE = 16
_NEVER = np.float32(-1e9)


def groups(classes: int) -> int:
    """The number of groups; a class belongs to that of its number by ``SIDE``."""
    return -(-classes // SIDE)


def shapes(classes: int) -> dict[str, tuple[int, ...]]:
    """Parameters by name."""
    return {
        "embed": (classes, WIDTH),
        "query": (WIDTH, WIDTH),
        "key": (WIDTH, WIDTH),
        "value": (WIDTH, WIDTH),
        "join": (WIDTH, WIDTH),
        "place": (2 * BLOCK,),
        "up": (WIDTH, HIDDEN),
        "up_bias": (HIDDEN,),
        "down": (HIDDEN, WIDTH),
        "out": (WIDTH, classes),
        "out_bias": (classes,),
        "group": (WIDTH, groups(classes)),
        "group_bias": (groups(classes),),
    }


def start(classes: int, seed: int = 3) -> np.ndarray:
    """Flat parameters that add nothing yet."""
    rng = np.random.default_rng(seed)
    parts = []
    for name, shape in shapes(classes).items():
        if name in ("out", "group") or len(shape) == 1:
            parts.append(np.zeros(shape))
        else:
            scale = 0.5 if name == "embed" else 1 / np.sqrt(shape[0])
            parts.append(rng.normal(0, scale, shape))
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def unpack(flat: np.ndarray, classes: int) -> dict[str, np.ndarray]:
    """Views of the flat parameters by name."""
    found, at = {}, 0
    for name, shape in shapes(classes).items():
        size = prod(shape)
        found[name] = flat[at : at + size].reshape(shape)
        at += size
    return found


def first_classes(p: dict[str, np.ndarray], classes: int) -> dict[str, np.ndarray]:
    """The parameters that foretell the first ``classes`` classes and no others."""
    n = groups(classes)
    return {**p, "group": p["group"][:, :n], "group_bias": p["group_bias"][:n]}


_REACH = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]
_PLACES = np.maximum(_REACH, 0)
_MASK = np.where(_REACH < 0, _NEVER, np.float32(0))


#: Scores above this are brought down before they are raised to a power.
_MOST = 60


def _softmax(x: np.ndarray) -> np.ndarray:
    if x.max() > _MOST:
        x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    # A product adds short rows up faster than a sum along them.
    x /= (x @ np.ones(x.shape[-1], x.dtype))[..., None]
    return x


def _times(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One product for all blocks."""
    return (x.reshape(-1, x.shape[-1]) @ weights).reshape(*x.shape[:-1], weights.shape[1])


class Follow:
    """Logits of the next class by the last class alone, for groups and inside them."""

    def __init__(self, follow: np.ndarray):
        k, n = len(follow), groups(len(follow))
        self.classes = k
        inside = np.full((k, n * SIDE), _NEVER, follow.dtype)
        inside[:, :k] = follow
        self.inside = inside.reshape(k, n, SIDE)
        top = self.inside.max(axis=2)
        self.group = top + np.log(np.exp(self.inside - top[:, :, None]).sum(axis=2))
        self.inside -= self.group[:, :, None]


def by_class(follow: np.ndarray | Follow) -> Follow:
    return follow if isinstance(follow, Follow) else Follow(follow)


def _before(x: np.ndarray) -> np.ndarray:
    """Each block's predecessor."""
    return np.concatenate([np.zeros_like(x[:1]), x[:-1]])


@dataclass
class Pass:
    """What a forward pass leaves for the backward pass."""

    p: dict[str, np.ndarray]
    follow: Follow
    classes: np.ndarray
    h: np.ndarray
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    a: np.ndarray
    o: np.ndarray
    y: np.ndarray
    f: np.ndarray
    z: np.ndarray

    @property
    def logits(self) -> np.ndarray:
        """Log probability (natural) of every class after every token."""
        z, before = self.z.reshape(-1, WIDTH), self.classes.ravel()
        every = [np.log(_softmax(inside(self, z, before, g))) for g in range(groups(self.follow.classes))]
        found = np.stack(every, axis=1) + np.log(_softmax(group_logits(self, z, before)))[:, :, None]
        return found.reshape(*self.classes.shape, -1)[:, :, : self.follow.classes]


def group_logits(x: Pass, z: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Logits of the groups after tokens with state ``z`` and class ``before``."""
    logits = z @ x.p["group"]
    logits += (x.follow.group + x.p["group_bias"])[before]
    return logits


def _columns(x: Pass, g: int) -> tuple[np.ndarray, np.ndarray]:
    """Output weights and bias of a group's classes."""
    own = slice(g * SIDE, min((g + 1) * SIDE, x.follow.classes))
    return x.p["out"][:, own], x.p["out_bias"][own]


def inside(x: Pass, z: np.ndarray, before: np.ndarray, g: int) -> np.ndarray:
    """Logits of the classes in group ``g``; those it lacks are never."""
    logits = x.follow.inside[before, g]
    out, bias = _columns(x, g)
    logits[:, : len(bias)] += z @ out + bias
    return logits


@dataclass
class Heads:
    """Weights for the targets of some tokens, in the order of the targets' groups.

    ``at`` are the tokens, ``runs`` each group with the slice of its tokens.
    """

    at: np.ndarray
    z: np.ndarray
    runs: list[tuple[int, slice]]
    group: np.ndarray
    own: np.ndarray
    of_group: np.ndarray
    of_own: np.ndarray

    @property
    def logs(self) -> np.ndarray:
        """Log probability (natural) of the targets."""
        found = np.log(np.maximum(self.of_group, 1e-30))
        found += np.log(np.maximum(self.of_own, 1e-30))
        return found


def heads(x: Pass, at: np.ndarray, goal: np.ndarray) -> Heads:
    """What the tokens ``at`` give the groups, and the classes in their target's group."""
    number = (goal // SIDE).astype(np.uint8 if x.follow.classes <= 256 * SIDE else np.int64)
    order = np.argsort(number, kind="stable")
    at, goal, number = at[order], goal[order], number[order]
    z, before = x.z.reshape(-1, WIDTH)[at], x.classes.ravel()[at]
    ends = np.searchsorted(number, np.arange(groups(x.follow.classes)), side="right").tolist()
    runs = [(g, slice(a, b)) for g, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
    own = x.follow.inside[before, number]
    for g, run in runs:
        out, bias = _columns(x, g)
        own[run, : len(bias)] += z[run] @ out + bias
    group, own = _softmax(group_logits(x, z, before)), _softmax(own)
    rows = np.arange(len(at))
    return Heads(at, z, runs, group, own, group[rows, number], own[rows, goal % SIDE])


def forward(
    p: dict[str, np.ndarray], follow: np.ndarray | Follow, classes: np.ndarray, first: np.ndarray
) -> Pass:
    """States after every token of the blocks, from which the next class is foretold.

    ``classes`` is (blocks, BLOCK); ``first`` marks blocks that have none before.
    ``follow`` has the logits that the last class alone gives; attention and the
    layer above it learn what has to be added to them.
    """
    h = p["embed"][classes]
    made = _times(h, np.concatenate([p["query"], p["key"], p["value"]], axis=1))
    q, kv = made[:, :, :WIDTH], made[:, :, WIDTH:]
    both = np.concatenate([_before(kv), kv], axis=1)
    k, v = both[:, :, :WIDTH], both[:, :, WIDTH:]
    scores = q @ k.transpose(0, 2, 1)
    scores *= np.float32(WIDTH**-0.5)
    scores += p["place"][_PLACES] + _MASK
    scores[first, :, :BLOCK] = _NEVER
    a = _softmax(scores)
    o = a @ v
    y = h + _times(o, p["join"])
    f = _times(y, p["up"])
    f += p["up_bias"]
    np.maximum(f, 0, out=f)
    z = y + _times(f, p["down"])
    return Pass(p, by_class(follow), classes, h, q, k, v, a, o, y, f, z)


def _outer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.reshape(-1, a.shape[-1]).T @ b.reshape(-1, b.shape[-1])


def gradient(
    flat: np.ndarray,
    follow: np.ndarray | Follow,
    classes: np.ndarray,
    first: np.ndarray,
    target: np.ndarray,
) -> tuple[float, np.ndarray]:
    """Mean loss (natural log) over targets and its gradient by the flat parameters.

    Negative targets are none: blocks that a sequence fills in part have them at
    their ends, where no token before looks.
    """
    follow = by_class(follow)
    p = unpack(flat, follow.classes)
    x = forward(p, follow, classes, first)
    goal = target.ravel()
    real = np.flatnonzero(goal >= 0)
    n = max(1, len(real))
    goal = goal[real]
    made = heads(x, real, goal)
    loss = float(-made.logs.sum() / n)
    sorted_goal = target.ravel()[made.at]
    rows = np.arange(len(real))
    dgroup, down = made.group, made.own
    dgroup[rows, sorted_goal // SIDE] -= 1
    down[rows, sorted_goal % SIDE] -= 1
    dgroup /= np.float32(n)
    down /= np.float32(n)
    g: dict[str, np.ndarray] = {
        "group": made.z.T @ dgroup,
        "group_bias": np.ones(len(real), dgroup.dtype) @ dgroup,
        "out": np.zeros_like(p["out"]),
        "out_bias": np.zeros_like(p["out_bias"]),
    }
    dreal = dgroup @ p["group"].T
    for number, run in made.runs:
        out, bias = _columns(x, number)
        d = down[run, : len(bias)]
        own = slice(number * SIDE, number * SIDE + len(bias))
        g["out"][:, own] = made.z[run].T @ d
        g["out_bias"][own] = np.ones(len(d), d.dtype) @ d
        dreal[run] += d @ out.T
    dz = np.zeros_like(x.z)
    dz.reshape(-1, WIDTH)[made.at] = dreal
    g["down"] = _outer(x.f, dz)
    df = _times(dz, p["down"].T) * (x.f > 0)
    g["up"], g["up_bias"] = _outer(x.y, df), np.ones(target.size, df.dtype) @ df.reshape(-1, HIDDEN)
    dy = dz + _times(df, p["up"].T)
    g["join"] = _outer(x.o, dy)
    do = _times(dy, p["join"].T)
    da = do @ x.v.transpose(0, 2, 1)
    ds = da * x.a
    ds -= x.a * (ds @ np.ones(2 * BLOCK, ds.dtype))[:, :, None]
    ds[first, :, :BLOCK] = 0
    g["place"] = np.bincount(
        _PLACES.ravel(), weights=np.where(_REACH < 0, 0, ds.sum(axis=0)).ravel(), minlength=2 * BLOCK
    )
    ds *= np.float32(WIDTH**-0.5)
    dmade = np.empty((*classes.shape, 3 * WIDTH), ds.dtype)
    dmade[:, :, :WIDTH] = ds @ x.k
    for own, both in ((1, ds.transpose(0, 2, 1) @ x.q), (2, x.a.transpose(0, 2, 1) @ do)):
        part = dmade[:, :, own * WIDTH : (own + 1) * WIDTH]
        part[:] = both[:, BLOCK:]
        # The share that each block's successor holds.
        part[:-1] += both[1:, :BLOCK]
    names = ("query", "key", "value")
    dh = dy + _times(dmade, np.concatenate([p[name] for name in names], axis=1).T)
    g.update(zip(names, np.split(_outer(x.h, dmade), 3, axis=1)))
    g["embed"] = np.zeros_like(p["embed"])
    order = np.argsort(classes.ravel(), kind="stable")
    seen, starts = np.unique(classes.ravel()[order], return_index=True)
    g["embed"][seen] = np.add.reduceat(dh.reshape(-1, WIDTH)[order], starts, axis=0)
    return loss, np.concatenate([g[name].ravel() for name in shapes(follow.classes)]).astype(np.float32)


class Adam:
    """Adam steps on flat parameters."""

    def __init__(self, size: int):
        self.mean, self.square, self.t = np.zeros(size, np.float32), np.zeros(size, np.float32), 0

    def step(self, flat: np.ndarray, grad: np.ndarray, rate: float) -> None:
        self.t += 1
        self.mean += 0.1 * (grad - self.mean)
        self.square += 0.01 * (grad * grad - self.square)
        mean = self.mean / (1 - 0.9**self.t)
        square = self.square / (1 - 0.99**self.t)
        flat -= (rate * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)
