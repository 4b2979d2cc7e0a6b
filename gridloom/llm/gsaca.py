"""Suffix arrays by linear grouping (after Baier, CPM 2016), without recursion or renaming, and the repeated
windows that they show.

Phase 1 starts with the suffixes grouped by first character and visits groups from the highest down. For a
group, each member's previous-smaller pointer is the nearest place to its left in a lower group; places that
more members point to are moved, in that order, to a new group right behind their old one. In the end a group
holds the suffixes that share a Lyndon prefix. Phase 2 reads the array from the left: each suffix placed lets
the one before it, and those its pointers lead to, take the first free place of their groups.

The kernel is a Java UDF of Spark, compiled by the compiler that Spark itself ships for generated code and sent
to the executors as a jar: such a loop over bytes takes microseconds a byte in Python. ``suffix_array`` has the
same steps in Python, for tests and for small texts.
"""

from __future__ import annotations

import io
import uuid
import zipfile

import numpy as np
from pyspark.sql import SparkSession

from gridloom.llm.session import shared_dir

CLASS = "gridloom.llm.RepeatedWindows"
FUNCTION = "gridloom_repeated_windows"
#: A segment in front of its bytes: group, doc, key, start and number of windows.
HEAD = np.dtype([("anchor", "<u4"), ("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("n", "<u4")])
MARK = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("end", "<u4")])

JAVA = r"""
package gridloom.llm;

import java.nio.ByteBuffer;
import java.nio.ByteOrder;

/* (heads, bodies, window width) -> marks: stretches of segments under windows that also start earlier. */
public class RepeatedWindows implements org.apache.spark.sql.api.java.UDF3 {
  static final int BATCH = 4 << 20;

  public Object call(Object headBlobs, Object bodyBlobs, Object width) throws Exception {
    scala.collection.Seq hs = (scala.collection.Seq) headBlobs, bs = (scala.collection.Seq) bodyBlobs;
    int w = ((Integer) width).intValue(), m = 0;
    for (int b = 0; b < hs.length(); b++) m += ((byte[]) hs.apply(b)).length / 28;
    long[] order = new long[m], doc = new long[m], key = new long[m];
    int[] start = new int[m], n = new int[m], blob = new int[m], from = new int[m];
    int s = 0;
    for (int b = 0; b < hs.length(); b++) {
      ByteBuffer h = ByteBuffer.wrap((byte[]) hs.apply(b)).order(ByteOrder.LITTLE_ENDIAN);
      int at = 0;
      while (h.hasRemaining()) {
        order[s] = ((h.getInt() & 0xffffffffL) << 31) | s;
        doc[s] = h.getLong(); key[s] = h.getLong(); start[s] = h.getInt(); n[s] = h.getInt();
        blob[s] = b; from[s] = at; at += n[s] - 1 + w; s++;
      }
    }
    java.util.Arrays.sort(order);
    java.io.ByteArrayOutputStream out = new java.io.ByteArrayOutputStream();
    for (int a = 0; a < m;) {               /* whole anchors, BATCH bytes at a time */
      int b = a; long size = 1;
      while (b < m) {
        int e = b; long more = 0;
        while (e < m && (order[e] >>> 31) == (order[b] >>> 31)) { more += n[(int) (order[e] & 0x7fffffffL)] + w; e++; }
        if (b > a && size + more > BATCH) break;
        size += more; b = e;
      }
      int count = b - a;
      int[] seg = new int[count], begin = new int[count + 1];
      char[] t = new char[(int) size];
      int at = 0;
      for (int k = 0; k < count; k++) {
        int g = (int) (order[a + k] & 0x7fffffffL);
        byte[] body = (byte[]) bs.apply(blob[g]);
        seg[k] = g; begin[k] = at;
        for (int i = 0; i < n[g] - 1 + w; i++) t[at++] = (char) ((body[from[g] + i] & 0xff) + 2);
        t[at++] = 1;
      }
      begin[count] = at; t[at++] = 0;
      marks(t, at, seg, begin, count, w, doc, key, start, n, out);
      a = b;
    }
    return out.toByteArray();
  }

  static void marks(char[] t, int size, int[] seg, int[] begin, int count, int w, long[] doc, long[] key, int[] start, int[] n, java.io.ByteArrayOutputStream out) {
    int[] sa = suffixArray(t, size);
    int[] own = new int[size];               /* segment of each window, -1 where none starts */
    java.util.Arrays.fill(own, -1);
    for (int k = 0; k < count; k++) java.util.Arrays.fill(own, begin[k], begin[k] + n[seg[k]], k);
    boolean[] again = new boolean[size];
    for (int r = 0; r < size;) {
      int e = r + 1;
      if (own[sa[r]] >= 0) {
        while (e < size && own[sa[e]] >= 0 && same(t, sa[e - 1], sa[e], w)) e++;
        if (e - r > 1) {
          int best = r;
          for (int q = r + 1; q < e; q++) if (before(sa[q], sa[best], own, seg, begin, doc, key, start)) best = q;
          for (int q = r; q < e; q++) again[sa[q]] = q != best;
        }
      }
      r = e;
    }
    ByteBuffer mark = ByteBuffer.allocate(24).order(ByteOrder.LITTLE_ENDIAN);
    for (int k = 0; k < count; k++) {
      int g = seg[k];
      for (int i = 0; i < n[g];) {
        if (!again[begin[k] + i]) { i++; continue; }
        int j = i;
        while (j < n[g] && again[begin[k] + j]) j++;
        mark.clear();
        mark.putLong(doc[g]).putLong(key[g]).putInt(start[g] + i).putInt(start[g] + j - 1 + w);
        out.write(mark.array(), 0, 24);
        i = j;
      }
    }
  }

  static boolean same(char[] t, int x, int y, int w) {
    for (int i = 0; i < w; i++) if (t[x + i] != t[y + i]) return false;
    return true;
  }

  static boolean before(int x, int y, int[] own, int[] seg, int[] begin, long[] doc, long[] key, int[] start) {
    int a = own[x], b = own[y], g = seg[a], h = seg[b];
    if (doc[g] != doc[h]) return doc[g] < doc[h];
    if (key[g] != key[h]) return key[g] < key[h];
    return start[g] + x - begin[a] < start[h] + y - begin[b];
  }

  /* t[0..n-1], t[n-1] the only least character. */
  static int[] suffixArray(char[] t, int n) {
    int sigma = 0;
    for (int i = 0; i < n; i++) sigma = Math.max(sigma, t[i] + 1);
    int[] sa = new int[n], at = new int[n], grp = new int[n], len = new int[n], prev = new int[n], cnt = new int[n], list = new int[n], byc = new int[n], old = new int[n], moved = new int[n];
    int[] head = new int[Math.max(n, sigma) + 2];
    for (int i = 0; i < n; i++) head[t[i] + 1]++;
    for (int c = 0; c < sigma; c++) head[c + 1] += head[c];
    for (int i = 0; i < n; i++) { int g = head[t[i]]; grp[i] = g; int p = g + len[g]++; sa[p] = i; at[i] = p; }
    java.util.Arrays.fill(head, 0);
    for (int hi = n - 1; hi >= 0;) {
      int g = grp[sa[hi]], m = 0, most = 0;
      for (int k = g; k <= hi; k++) {          /* nearest place to the left that is not in a higher group */
        int p = sa[k] - 1;
        while (p >= 0 && grp[p] > g) p = prev[p];
        prev[sa[k]] = p;
      }
      for (int k = g; k <= hi; k++) {          /* through members of this group to a lower one */
        int p = prev[sa[k]];
        while (p >= 0 && grp[p] == g) p = prev[p];
        int j = sa[k];
        while (j != p) { int q = prev[j]; prev[j] = p; j = q; }
        if (p >= 0) { if (cnt[p] == 0) list[m++] = p; most = Math.max(most, ++cnt[p]); }
      }
      for (int k = 0; k < m; k++) head[cnt[list[k]]]++;
      int sum = 0;
      for (int c = most; c >= 1; c--) { int x = head[c]; head[c] = sum; sum += x; }
      for (int k = 0; k < m; k++) byc[head[cnt[list[k]]]++] = list[k];
      for (int c = 1; c <= most; c++) head[c] = 0;
      for (int a = 0; a < m;) {                /* most pointers first */
        int b = a, c = cnt[byc[a]], olds = 0;
        while (b < m && cnt[byc[b]] == c) b++;
        for (int k = a; k < b; k++) {          /* to the end of their groups */
          int j = byc[k], o = grp[j];
          if (moved[o] == 0) old[olds++] = o;
          int e = o + len[o] - ++moved[o], x = sa[e], f = at[j];
          sa[e] = j; at[j] = e; sa[f] = x; at[x] = f;
        }
        for (int k = a; k < b; k++) { int j = byc[k], o = grp[j]; grp[j] = o + len[o] - moved[o]; }
        for (int k = 0; k < olds; k++) {
          int o = old[k], s = o + len[o] - moved[o];
          if (s != o) { len[s] = moved[o]; len[o] -= moved[o]; }
          moved[o] = 0;
        }
        a = b;
      }
      for (int k = 0; k < m; k++) cnt[list[k]] = 0;
      hi = g - 1;
    }
    for (int i = 0; i < n; i++) len[i] = i;    /* from here the next free place of each group; cnt: placed */
    sa[0] = n - 1; cnt[n - 1] = 1; len[grp[n - 1]]++;
    for (int r = 0; r < n; r++)
      for (int j = sa[r] - 1; j >= 0 && cnt[j] == 0; j = prev[j]) { sa[len[grp[j]]++] = j; cnt[j] = 1; }
    return sa;
  }
}
"""


def suffix_array(t) -> np.ndarray:
    """Suffix array of t (non-negative integers), whose last character is its only least one."""
    t = np.asarray(t, np.int64)
    n = len(t)
    sa = np.argsort(t, kind="stable").tolist()
    start = np.searchsorted(np.sort(t), t, "left")
    grp = start.tolist()
    size = np.bincount(start, minlength=n).tolist()
    at = [0] * n
    for r, i in enumerate(sa):
        at[i] = r
    prev = [-1] * n
    hi = n - 1
    while hi >= 0:
        g = grp[sa[hi]]
        members = sa[g : hi + 1]
        for i in members:
            p = i - 1
            while p >= 0 and grp[p] > g:
                p = prev[p]
            prev[i] = p
        count: dict[int, int] = {}
        for i in members:
            path, p = [i], prev[i]
            while p >= 0 and grp[p] == g:
                path.append(p)
                p = prev[p]
            for j in path:
                prev[j] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        by: dict[int, list[int]] = {}
        for p, c in count.items():
            by.setdefault(c, []).append(p)
        for c in sorted(by, reverse=True):
            moved: dict[int, int] = {}
            for j in by[c]:
                o = grp[j]
                moved[o] = moved.get(o, 0) + 1
                e, f = o + size[o] - moved[o], at[j]
                x = sa[e]
                sa[e], sa[f], at[j], at[x] = j, x, e, f
            for j in by[c]:
                grp[j] += size[grp[j]] - moved[grp[j]]
            for o, m in moved.items():
                if size[o] != m:
                    size[o + size[o] - m] = m
                    size[o] -= m
        hi = g - 1
    free = list(range(n))
    placed = [False] * n
    out = [-1] * n
    out[0] = n - 1
    placed[n - 1] = True
    free[grp[n - 1]] += 1
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            out[free[grp[j]]] = j
            free[grp[j]] += 1
            placed[j] = True
            j = prev[j]
    return np.array(out, np.int32)


def register(spark: SparkSession) -> str:
    """Compile the kernel, send it to the executors and register it; the function's name."""
    context = spark.sparkContext
    loaded = getattr(context, "_gridloom_kernel", None)
    if loaded is None:
        compiler = context._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(JAVA)
        code = compiler.getBytecodes()
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for name in code.keySet():
                z.writestr(name.replace(".", "/") + ".class", bytes(code.get(name)))
        path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gridloom-kernel-{uuid.uuid4().hex}.jar")
        out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(packed.getvalue()))
        out.close()
        context._jsc.sc().addJar(path.toString())
        new = lambda kind: context._gateway.new_array(kind, 0)
        loaded = compiler.getClassLoader().loadClass(CLASS).getDeclaredConstructor(new(context._jvm.java.lang.Class)).newInstance(new(context._jvm.java.lang.Object))
        context._gridloom_kernel = loaded
    spark._jsparkSession.udf().register(FUNCTION, loaded, context._jvm.org.apache.spark.sql.types.DataType.fromDDL("binary"))
    return FUNCTION
