"""Documented JavaScript types as TypeScript: a small grammar, read by descent.

    union   = part { "|" part }
    part    = { "?" | "!" | "..." } base { "[]" } [ "=" ]
    base    = "(" union ")" | "{" fields "}" | "function" [ "(" unions ")" [ ":" union ] ]
            | name [ [ "." ] "<" unions ">" ] | "*" | a quoted string or number

What can't be read is ``any``.
"""

from __future__ import annotations

import re

# Names of documented types and what they are in TypeScript.
NAMES = {
    "*": "any", "?": "any", "any": "any", "mixed": "any", "string": "string", "number": "number", "int": "number", "integer": "number", "float": "number",
    "boolean": "boolean", "bool": "boolean", "true": "true", "false": "false", "null": "null", "undefined": "undefined", "void": "void", "object": "Record<string, any>",
    "array": "any[]", "function": "(...args: any[]) => any", "promise": "Promise<any>", "node": "Node", "htmlelement": "HTMLElement", "regexp": "RegExp", "date": "Date", "error": "Error",
}
_TOKEN = re.compile(r"\s*(\.\.\.|\[\]|=>|[|?!=(){}<>,:]|\.(?=<)|[A-Za-z_$][\w$]*(?:[.~#/:](?=[A-Za-z_$])[\w$]+)*|\d+(?:\.\d+)?|'[^']*'|\"[^\"]*\"|\*)")


class _Reader:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        while at < len(text.rstrip()):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(text)
            self.tokens.append(m[1])
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self, wanted: str | None = None) -> str:
        t = self.peek()
        if t is None or (wanted is not None and t != wanted):
            raise ValueError(f"{wanted} is not {t}")
        self.at += 1
        return t

    def union(self) -> str:
        parts = [self.part()]
        while self.peek() == "|":
            self.take()
            parts.append(self.part())
        flat = list(dict.fromkeys(parts))
        return "any" if "any" in flat else " | ".join(f"({p})" if "=>" in p and len(flat) > 1 else p for p in flat)

    def part(self) -> str:
        orNull = rest = False
        while self.peek() in ("?", "!", "..."):
            t = self.take()
            orNull, rest = orNull or t == "?", rest or t == "..."
            if t == "?" and self.peek() in (None, "|", ",", ">", ")", "}"):
                return "any"
        out = self.base()
        while self.peek() == "[]":
            self.take()
            out = _array(out)
        if self.peek() == "=":
            self.take()
            out = out if out == "any" else f"{out} | undefined"
        if orNull and out != "any":
            out = f"{out} | null"
        return _array(out) if rest else out

    def listed(self, end: str) -> list[str]:
        out = []
        while self.peek() != end:
            if out:
                self.take(",")
            out.append(self.union())
        self.take(end)
        return out

    def base(self) -> str:
        t = self.take()
        if t == "(":
            inner = self.union()
            self.take(")")
            return f"({inner})" if "|" in inner or "=>" in inner else inner
        if t == "{":
            fields = []
            while self.peek() != "}":
                if fields:
                    self.take(",")
                name = self.take().split(":")[0]
                optional = self.peek() == "?" and bool(self.take())
                known = self.peek() == ":" and bool(self.take())
                fields.append(f"{name}{'?' if optional else ''}: {self.union() if known else 'any'}")
            self.take("}")
            return "{ " + "; ".join(fields) + " }" if fields else "{}"
        if t.lower() == "function" and self.peek() == "(":
            self.take()
            taken = self.listed(")")
            gives = "any"
            if self.peek() == ":":
                self.take()
                gives = self.union()
            return "(" + ", ".join(f"a{i}: {x}" for i, x in enumerate(taken)) + f") => {gives}"
        if t[0] in "'\"" or t[0].isdigit():
            return t
        if not re.match(r"[A-Za-z_$*]", t):
            raise ValueError(t)
        if self.peek() == ".":
            self.take()
        if self.peek() == "<":
            self.take()
            inside = self.listed(">")
            return {"array": lambda: _array(" | ".join(inside)), "object": lambda: f"Record<{inside[0] if len(inside) > 1 and inside[0] in ('string', 'number') else 'string'}, {inside[-1] if inside else 'any'}>"}.get(t.lower(), lambda: f"{t}<{', '.join(inside)}>")()
        if t.lower() in NAMES:
            return NAMES[t.lower()]
        return "any" if re.search(r"[~#/:]", t) else t


def _array(of: str) -> str:
    return f"({of})[]" if re.search(r"[|]|=>", of) and not re.fullmatch(r"\([^()]*\)", of) else f"{of}[]"


def typescript(documented: str | None) -> str:
    """The TypeScript of a documented type."""
    try:
        r = _Reader(documented or "")
        out = r.union()
        return out if r.peek() is None else "any"
    except ValueError:
        return "any"
    except RecursionError:
        return "any"


def braced(text: str) -> tuple[str | None, str]:
    """(what stands between the braces that the text begins with, the rest); None without braces that end."""
    if not text.startswith("{"):
        return None, text
    depth = 0
    for i, c in enumerate(text):
        depth += (c == "{") - (c == "}")
        if not depth:
            return text[1:i].strip(), text[i + 1 :].strip()
    return None, text


_KINDS = {"namespace", "class", "typedef", "function", "method", "constructor", "callback", "member", "constant", "module"}
_NAMED = re.compile(r"^(?:(?:async|export|default|static|function|const|let|var)\s+)*([A-Za-z_$][\w$.]*)\s*(?:[=:]\s*(?:async\s*)?(?:function)?\s*)?(\()?")


def documented_symbol(comment: str, declares: str) -> dict:
    """What a documentation comment says: text, kind, name, what it belongs to, parameters and result, with TypeScript types."""
    out = {"description": "", "kind": None, "name": None, "memberof": None, "params": [], "returns": None, "deprecated": False}
    parts = re.split(r"(?m)^\s*@(?=\w)", comment)
    out["description"] = parts[0].strip()
    for tag in parts[1:]:
        word, _, rest = tag.partition("\n")[0].partition(" ")
        rest = (rest + "\n" + tag.partition("\n")[2]).strip()
        kind, after = braced(rest)
        if word in ("param", "arg", "argument"):
            m = re.match(r"\[\s*([\w$.]+)\s*(?:=\s*((?:[^\[\]]|\[[^\[\]]*\])*))?\]|([\w$.]+)", after)
            if m and "." not in (name := m[1] or m[3]):
                text = re.sub(r"^\s*-\s*", "", after[m.end() :]).strip()
                spread = (kind or "").strip().startswith("...")
                out["params"].append({"name": name, "type": typescript(kind), "optional": m[1] is not None or (kind or "").rstrip().endswith("="), "rest": spread, "default": m[2], "description": re.sub(r"\s+", " ", text)})
        elif word in ("returns", "return"):
            out["returns"] = typescript(kind)
        elif word in ("memberof", "memberOf"):
            out["memberof"] = rest.split("\n")[0].strip().rstrip(".#~").removesuffix(".prototype") or None
        elif word == "name":
            out["name"] = rest.split("\n")[0].strip()
        elif word == "deprecated":
            out["deprecated"] = True
        elif word in _KINDS:
            out["kind"] = word if word not in ("constructor", "callback", "method") else {"constructor": "class", "callback": "typedef", "method": "function"}[word]
            if word in ("typedef", "member", "constant") and kind:
                out["returns"] = typescript(kind)
            named = (after if kind else rest).split("\n")[0].strip()
            out["name"] = named or out["name"]
    m = _NAMED.match(declares.strip())
    if m and not out["name"]:
        out["name"] = m[1]
    if out["kind"] is None:
        out["kind"] = "function" if (m and m[2]) or out["params"] or out["returns"] else "member"
    if out["name"] and "." in out["name"] and not out["memberof"]:
        out["memberof"], _, out["name"] = out["name"].rpartition(".")
    return out
