"""Terms that tell whose traces these are, as far as this machine knows: names of user, host and mail, ssh hosts, session folders."""

from __future__ import annotations

import os
import re
import socket
import subprocess
from collections.abc import Callable, Iterator, Mapping

from ..fixed import PRIVATE_TERM_DENYLIST

#: Names that tell nobody apart.
COMMON = {*PRIVATE_TERM_DENYLIST, "root"}
_WORD = re.compile(r"[A-Za-z0-9]+")


def git_setting(name: str) -> str:
    """A global setting of git; nothing where there is no git or no such setting."""
    try:
        return subprocess.run(["git", "config", "--global", name], capture_output=True, text=True, timeout=10, check=True).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return ""


def _account(home: str, user: str, environ: Mapping[str, str], host: str) -> Iterator[str]:
    yield from (user, os.path.basename(home.rstrip("/")), environ.get("USER", ""), environ.get("LOGNAME", ""), host.partition(".")[0])


def _git_name(full: str) -> Iterator[str]:
    """The name, each of its words of three letters or more, and those written as one."""
    words = [w for w in _WORD.findall(full) if len(w) >= 3]
    yield from (full, *words)
    if len(words) > 1:
        yield "".join(words)


def _session_folders(home: str) -> Iterator[str]:
    """Words of four letters or more in the names of encoded session folders."""
    folder = os.path.join(home, ".pi", "agent", "sessions")
    if os.path.isdir(folder):
        yield from (w for e in os.scandir(folder) if e.is_dir() for w in _WORD.findall(e.name) if len(w) >= 4)


def _ssh_hosts(home: str) -> Iterator[str]:
    """Aliases of the ssh configuration that are no patterns."""
    try:
        with open(os.path.join(home, ".ssh", "config"), encoding="utf-8", errors="ignore") as f:
            entries = [line.split() for line in f]
    except OSError:
        return
    yield from (alias for e in entries if len(e) > 1 and e[0].lower() == "host" for alias in e[1:] if not set("*?") & set(alias))


def private_terms(home: str, user: str | None = None, environ: Mapping[str, str] | None = None, host: str | None = None, git: Callable[[str], str] = git_setting) -> tuple[str, ...]:
    """Private terms found on this machine, longest first.

    Terms have three characters or more, without marks at their ends, and are
    none of the common ones.  A mail's domain is one if it holds another term of
    four characters or more.
    """
    home = os.path.expanduser(home)
    local, _, domain = git("user.email").partition("@")
    every = [*_account(home, user or "", os.environ if environ is None else environ, socket.gethostname() if host is None else host), *_git_name(git("user.name")), local]
    tidy = lambda terms: {t for t in (x.strip().strip("-_.") for x in terms) if len(t) >= 3 and t.lower() not in COMMON}
    if any(t.lower() in domain.lower() for t in tidy(every) if len(t) >= 4):
        every.append(domain)
    found = tidy([*every, *_session_folders(home), *_ssh_hosts(home)])
    return tuple(sorted(found, key=lambda t: (-len(t), t.lower(), t)))
