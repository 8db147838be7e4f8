"""Documented symbols and their types, UCI files, shell helpers, hotplug scripts, typed declarations."""

import pytest

from siltstone.functions import types
from siltstone.operators import release
from siltstone.sources import extractors


@pytest.mark.parametrize(
    ("documented", "want"),
    [
        ("string", "string"), ("*", "any"), ("?", "any"), (None, "any"), ("?string", "string | null"), ("!Node", "Node"), ("string|number", "string | number"), ("(string|null)[]", "(string | null)[]"),
        ("Array<string>", "string[]"), ("Array.<string|number>", "(string | number)[]"), ("Array", "any[]"), ("Object<string, number>", "Record<string, number>"), ("Object<string, Array<Lib.form.Value>>", "Record<string, Lib.form.Value[]>"),
        ("Promise<Array<string>>", "Promise<string[]>"), ("function(string, number=): boolean", "(a0: string, a1: number | undefined) => boolean"), ("function", "(...args: any[]) => any"), ("function|null", "((...args: any[]) => any) | null"),
        ("{a: number, b?: Array<string>, c}", "{ a: number; b?: string[]; c: any }"), ("{}", "{}"), ("...string", "string[]"), ("number=", "number | undefined"), ("'on'|'off'", "'on' | 'off'"), ("Lib.dom", "Lib.dom"),
        ("module:x~y", "any"), ("Array<", "any"), ("string string", "any"), ("*|string", "any"), ("string[][]", "string[][]"), ("{a: {b: number}}", "{ a: { b: number } }"), ("(" * 3000, "any"),
    ],
)
def test_types(documented, want):
    assert types.typescript(documented) == want


SOURCE = """
/**
 * The form.
 * @namespace Lib.form
 */
var form = {};
/**
 * A value.
 * @class Value
 * @memberof Lib.form
 * @param {Map} map - The map
 * @param {string} [title='a [b]'] Its title
 */
var Value = Class.extend({
    /**
     * Loads it.
     * @memberof Lib.form.Value
     * @param {{id: string, on?: boolean}} opts
     * @param {string} opts.id inner
     * @param {...number} more
     * @returns {Promise<Array<string>>} what is there
     * @deprecated
     */
    load: function(opts, more) {},
});
/**
 * @memberof Lib
 * @param {string} a
 */
function ping(a) {}
/**
 * @typedef {Object<string, number>} Sizes
 * @memberof Lib
 */
/** @memberof Lib */
const version = 1;
"""


def test_javascript(spark):
    found = {r["name"]: r for r in extractors.javascript(spark.createDataFrame([("f.js", SOURCE), ("g.js", None)], "path string, content string")).collect()}
    assert {n: (r["kind"], r["memberof"], r["returns"]) for n, r in found.items()} == {"form": ("namespace", "Lib", None), "Value": ("class", "Lib.form", None), "load": ("function", "Lib.form.Value", "Promise<string[]>"), "ping": ("function", "Lib", None), "Sizes": ("typedef", "Lib", "Record<string, number>"), "version": ("member", "Lib", None)}
    assert found["load"]["deprecated"] and [(p["name"], p["type"], p["rest"]) for p in found["load"]["params"]] == [("opts", "{ id: string; on?: boolean }", False), ("more", "number[]", True)]
    assert [(p["name"], p["optional"], p["default"], p["description"]) for p in found["Value"]["params"]] == [("map", False, None, "The map"), ("title", True, "'a [b]'", "Its title")]


def test_declarations_with_types(spark):
    symbols = extractors.javascript(spark.createDataFrame([("f.js", SOURCE)], "path string, content string"))
    assert release.typed_declarations(symbols, "Lib").first()["source"] == (
        "declare namespace Lib {\n"
        "    type Sizes = Record<string, number>;\n"
        "    function ping(a: string): any;\n"
        "    const version: any;\n"
        "    namespace form {\n\n    }\n"
        "    namespace form { class Value {\n"
        "        constructor(map: Map, title?: string);\n"
        "        load(opts: { id: string; on?: boolean }, ...more: number[]): Promise<string[]>;\n"
        "    } }\n"
        "}\n"
    )


def test_uci(spark):
    content = "# c\noption stray 1\nconfig interface 'lan'\n\toption proto 'static'\n\toption  proto \"dhcp\"\n\tlist dns '8.8.8.8'\n\tlist dns '1.1 x'\nconfig rule\n  # option no 1\n  option name Allow-Ping # why\r\n\nconfig\nconfig empty\n"
    rows = extractors.uci(spark.createDataFrame([("network", content), ("none", None)], "path string, content string")).collect()
    assert sorted((r["section"], r["type"], r["name"], r["kind"], r["key"], r["value"]) for r in rows if r["name"]) == [(0, "interface", "lan", "list", "dns", "1.1 x"), (0, "interface", "lan", "list", "dns", "8.8.8.8"), (0, "interface", "lan", "option", "proto", "dhcp")]
    assert [(r["section"], r["type"], r["key"], r["value"]) for r in rows if not r["name"]] == [(1, "rule", "name", "Allow-Ping")]


def test_shell_functions(spark):
    content = "#!/bin/sh\n\n# open_instance([name])\n#   opens an instance\nopen_instance() {\n  :\n}\n\nplain() {\n}\n# says nothing of arguments\nother() {\n}\n"
    rows = extractors.shell_functions(spark.createDataFrame([("helpers.sh", content)], "path string, content string")).orderBy("ordinal").collect()
    assert [(r["name"], r["arguments"], r["description"]) for r in rows] == [("open_instance", "[name]", "opens an instance"), ("other", "", "says nothing of arguments")]


def test_hotplug(spark):
    content = '#!/bin/sh\n# $IGNORED\n[ "$ACTION" = ifup ] || exit 0\ncase "$ACTION" in\n  add|remove) echo ${INTERFACE} ;;\n  change)\n   echo "$DEVICE" ;;\nesac\n'
    rows = extractors.hotplug(spark.createDataFrame([("etc/hotplug.d/iface/20-firewall", content), ("hotplug.d/usb/x", "echo"), ("etc/other", content)], "path string, content string")).orderBy("path").collect()
    assert [(r["subsystem"], r["order"], r["name"], r["variables"], r["actions"]) for r in rows] == [("iface", 20, "firewall", ["ACTION", "DEVICE", "INTERFACE"], ["add", "change", "ifup", "remove"]), ("usb", None, "x", [], [])]
