"""Geometry kernel: JVM functions over WKB, compiled on first use by the compiler that Spark itself carries.

Each operation is one expression over the geometry library on Spark's own classpath, wrapped in a null-safe JVM
UDF, so geometry never leaves the JVM. ``ensure`` compiles the classes, adds them to the session as a jar and
registers them; it is idempotent per session. Null in, null out; empty results are empty geometries.
"""

from __future__ import annotations

import io
import uuid
import zipfile

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from terraloom.common import store
from terraloom.functions.scalar import GRS80_A, LCC_3112, lcc_constants

_PKG = "terraloom.geo"


def _each(change: str) -> str:
    """Java that changes every coordinate ``c`` of a copy, with the constants of the national grid at hand."""
    e, n, f, rho0 = lcc_constants()
    named = {"A": GRS80_A, "E": e, "N": n, "F": f, "R0": rho0, "LON0": LCC_3112["lon0"]}
    consts = " ".join(f"final double {k} = {v!r};" for k, v in named.items())
    return (
        "Geometry n = a.copy(); n.apply(new org.locationtech.jts.geom.CoordinateFilter() { public void filter(org.locationtech.jts.geom.Coordinate c) {"
        f" {consts} {change} }} }}); n.geometryChanged(); return out(n);"
    )


#: name -> (argument kinds, result type, Java statement). g: geometry, d: double, a: array of geometries, b: bytes as they are, r: array of rows.
_OPS: dict[str, tuple[str, str, str]] = {
    "area": ("g", "double", "return Double.valueOf(a.getArea());"),
    "length": ("g", "double", "return Double.valueOf(a.getLength());"),
    "perimeter": ("g", "double", "return Double.valueOf(a.getBoundary().getLength());"),
    "type": ("g", "string", "return a.getGeometryType();"),
    "is_empty": ("g", "boolean", "return Boolean.valueOf(a.isEmpty());"),
    "is_valid": ("g", "boolean", "return Boolean.valueOf(a.isValid());"),
    "invalid_reason": (
        "g", "string",
        "org.locationtech.jts.operation.valid.TopologyValidationError e = new org.locationtech.jts.operation.valid.IsValidOp(a).getValidationError();"
        " return e == null ? null : e.getMessage();",
    ),
    "make_valid": ("g", "binary", "return out(org.locationtech.jts.geom.util.GeometryFixer.fix(a));"),
    "centroid": ("g", "binary", "return out(a.getCentroid());"),
    "inside_point": ("g", "binary", "Geometry c = a.getCentroid(); return out(a.contains(c) ? c : a.getInteriorPoint());"),
    "boundary": ("g", "binary", "return out(a.getBoundary());"),
    "exterior": (
        "g", "binary",
        "java.util.List p = org.locationtech.jts.geom.util.PolygonExtracter.getPolygons(a); java.util.List r = new java.util.ArrayList();"
        " for (int i = 0; i < p.size(); i++) r.add(((org.locationtech.jts.geom.Polygon) p.get(i)).getExteriorRing()); return out(a.getFactory().buildGeometry(r));",
    ),
    "holes": (
        "g", "array<binary>",
        "java.util.List p = org.locationtech.jts.geom.util.PolygonExtracter.getPolygons(a); java.util.List r = new java.util.ArrayList();"
        " for (int k = 0; k < p.size(); k++) { org.locationtech.jts.geom.Polygon q = (org.locationtech.jts.geom.Polygon) p.get(k);"
        " for (int i = 0; i < q.getNumInteriorRing(); i++) r.add(out(q.getInteriorRingN(i))); }"
        " return scala.jdk.javaapi.CollectionConverters.asScala(r).toSeq();",
    ),
    "parts": (
        "g", "array<binary>",
        "java.util.List r = new java.util.ArrayList(); for (int i = 0; i < a.getNumGeometries(); i++) if (!a.getGeometryN(i).isEmpty()) r.add(out(a.getGeometryN(i)));"
        " return scala.jdk.javaapi.CollectionConverters.asScala(r).toSeq();",
    ),
    "coords": (
        "g", "array<double>",
        "java.util.List r = new java.util.ArrayList(); org.locationtech.jts.geom.Coordinate[] c = a.getCoordinates();"
        " for (int i = 0; i < c.length; i++) { r.add(Double.valueOf(c[i].x)); r.add(Double.valueOf(c[i].y)); }"
        " return scala.jdk.javaapi.CollectionConverters.asScala(r).toSeq();",
    ),
    "polygons_only": (
        "g", "binary",
        "java.util.List p = org.locationtech.jts.geom.util.PolygonExtracter.getPolygons(a);"
        " return p.isEmpty() ? null : out(a.getFactory().buildGeometry(p));",
    ),
    "orient": (
        "g", "binary",
        "Geometry n = a.copy(); n.apply(new org.locationtech.jts.geom.GeometryComponentFilter() { public void filter(Geometry g) {"
        " if (g instanceof org.locationtech.jts.geom.Polygon) { org.locationtech.jts.geom.Polygon p = (org.locationtech.jts.geom.Polygon) g;"
        " turn(p.getExteriorRing(), true); for (int i = 0; i < p.getNumInteriorRing(); i++) turn(p.getInteriorRingN(i), false); } } }); return out(n);",
    ),
    "is_ccw": (
        "g", "boolean",
        "java.util.List p = org.locationtech.jts.geom.util.PolygonExtracter.getPolygons(a);"
        " for (int i = 0; i < p.size(); i++) if (!org.locationtech.jts.algorithm.Orientation.isCCW(((org.locationtech.jts.geom.Polygon) p.get(i)).getExteriorRing().getCoordinateSequence())) return Boolean.FALSE;"
        " return Boolean.TRUE;",
    ),
    "x0": ("g", "double", "return a.isEmpty() ? null : Double.valueOf(a.getEnvelopeInternal().getMinX());"),
    "y0": ("g", "double", "return a.isEmpty() ? null : Double.valueOf(a.getEnvelopeInternal().getMinY());"),
    "x1": ("g", "double", "return a.isEmpty() ? null : Double.valueOf(a.getEnvelopeInternal().getMaxX());"),
    "y1": ("g", "double", "return a.isEmpty() ? null : Double.valueOf(a.getEnvelopeInternal().getMaxY());"),
    "n_points": ("g", "int", "return Integer.valueOf(a.getNumPoints());"),
    "unique_vertices": (
        "g", "int",
        "java.util.Set s = new java.util.HashSet(); org.locationtech.jts.geom.Coordinate[] c = a.getCoordinates();"
        " for (int i = 0; i < c.length; i++) s.add(new org.locationtech.jts.geom.Coordinate(c[i].x, c[i].y)); return Integer.valueOf(s.size());",
    ),
    "text": ("g", "string", "return new org.locationtech.jts.io.WKTWriter().write(a);"),
    "to_3112": ("g", "binary", _each("double s = Math.sin(Math.toRadians(c.y)) * E; double t = Math.tan(Math.PI / 4 - Math.toRadians(c.y) / 2) / Math.pow((1 - s) / (1 + s), E / 2);"
        " double r = A * F * Math.pow(t, N); double h = N * Math.toRadians(c.x - LON0); c.x = r * Math.sin(h); c.y = R0 - r * Math.cos(h);")),
    "from_mercator": ("g", "binary", _each("c.x = Math.toDegrees(c.x / A); c.y = Math.toDegrees(2 * Math.atan(Math.exp(c.y / A)) - Math.PI / 2);")),
    "scaled": ("gd", "binary", "return out(org.locationtech.jts.geom.util.AffineTransformation.scaleInstance(b, b).transform(a));"),
    "moved": ("gdd", "binary", "return out(org.locationtech.jts.geom.util.AffineTransformation.translationInstance(b, c).transform(a));"),
    "from_text": ("s", "binary", "return out(new org.locationtech.jts.io.WKTReader().read(a));"),
    "buffer": ("gd", "binary", "return out(a.buffer(b, 16));"),
    "buffer0": ("g", "binary", "return out(a.buffer(0));"),
    "normalize": ("g", "binary", "return out(a.norm());"),
    "close": ("gd", "binary", "return out(a.buffer(b, 16).buffer(-b, 16));"),
    "simplify": ("gd", "binary", "return out(org.locationtech.jts.simplify.TopologyPreservingSimplifier.simplify(a, b));"),
    "point_along": ("gd", "binary", "return out(a.getFactory().createPoint(new org.locationtech.jts.linearref.LengthIndexedLine(a).extractPoint(b)));"),
    "distance": ("gg", "double", "return Double.valueOf(a.distance(b));"),
    "nearest_on": (
        "gg", "binary",
        "if (a.isEmpty() || b.isEmpty()) return null;"
        " return out(a.getFactory().createPoint(org.locationtech.jts.operation.distance.DistanceOp.nearestPoints(a, b)[1]));",
    ),
    "is_near": ("ggd", "boolean", "return Boolean.valueOf(a.isWithinDistance(b, c));"),
    "overlap": (
        "gg", "struct<area: double, x: double, y: double>",
        "if (!a.intersects(b) || a.touches(b)) return null; Geometry o = over(a, b, org.locationtech.jts.operation.overlayng.OverlayNG.INTERSECTION);"
        " if (o.isEmpty()) return null; org.locationtech.jts.geom.Point c = o.getCentroid();"
        " return org.apache.spark.sql.RowFactory.create(new Object[]{Double.valueOf(o.getArea()), Double.valueOf(c.getX()), Double.valueOf(c.getY())});",
    ),
    # Parts on the rim of the cut that have fewer dimensions than the geometry are left out; the box is grown, so they lie outside b's.
    "cut_to_box": (
        "gg", "binary",
        "org.locationtech.jts.geom.Envelope e = new org.locationtech.jts.geom.Envelope(b.getEnvelopeInternal()); e.expandBy(0.01 * (e.getWidth() + e.getHeight()) + 1e-9);"
        " if (e.contains(a.getEnvelopeInternal())) return out(a);"
        " Geometry o = over(a, a.getFactory().toGeometry(e), org.locationtech.jts.operation.overlayng.OverlayNG.INTERSECTION);"
        " if (a.getDimension() == 2) return out(a.getFactory().buildGeometry(org.locationtech.jts.geom.util.PolygonExtracter.getPolygons(o)));"
        " if (a.getDimension() == 1) return out(a.getFactory().buildGeometry(org.locationtech.jts.geom.util.LineStringExtracter.getLines(o))); return out(o);",
    ),
    "intersects": ("gg", "boolean", "return Boolean.valueOf(a.intersects(b));"),
    "touches": ("gg", "boolean", "return Boolean.valueOf(a.touches(b));"),
    "contains": ("gg", "boolean", "return Boolean.valueOf(a.contains(b));"),
    "within": ("gg", "boolean", "return Boolean.valueOf(a.within(b));"),
    "equals_exact": ("ggd", "boolean", "return Boolean.valueOf(a.equalsExact(b, c));"),
    "intersection": ("gg", "binary", "return out(over(a, b, org.locationtech.jts.operation.overlayng.OverlayNG.INTERSECTION));"),
    "difference": ("gg", "binary", "return out(over(a, b, org.locationtech.jts.operation.overlayng.OverlayNG.DIFFERENCE));"),
    "union": ("gg", "binary", "return out(over(a, b, org.locationtech.jts.operation.overlayng.OverlayNG.UNION));"),
    # Outlines the pair functions below measure edge by edge: 1 valid polygons in plain WKB, 2 such on whole numbers with edges along the axes or
    # diagonals, where that arithmetic is exact, 0 all others, which go through the overlay.
    "plain": (
        "b", "int",
        "java.nio.ByteBuffer r = java.nio.ByteBuffer.wrap(a); turned(r); int t = r.getInt(); Geometry g = in(a);"
        " if ((t != 3 && t != 6) || g.isEmpty() || !g.isValid()) return Integer.valueOf(0); return Integer.valueOf(whole(edges(a)) ? 2 : 1);",
    ),
    "shared": (
        "bbdd", "struct<area: double, x: double, y: double>",
        "if (c > 0 && d > 0) { double[] e = edges(a); double[] f = edges(b); if (few(e, f)) { double[] m = common(e, f); boolean sure = c == 2 && d == 2;"
        " if (sure && m[0] <= 0) return null; if (sure || m[0] > 1e-9 * m[3])"
        " return org.apache.spark.sql.RowFactory.create(new Object[]{Double.valueOf(m[0]), Double.valueOf(m[1]), Double.valueOf(m[2])}); } }"
        " Geometry g = in(a); Geometry h = in(b); if (!g.intersects(h)) return null;"
        " Geometry o = over(g, h, org.locationtech.jts.operation.overlayng.OverlayNG.INTERSECTION); if (o.isEmpty()) return null; org.locationtech.jts.geom.Point p = o.getCentroid();"
        " return org.apache.spark.sql.RowFactory.create(new Object[]{Double.valueOf(o.getArea()), Double.valueOf(p.getX()), Double.valueOf(p.getY())});",
    ),
    "shared_area": (
        "bbdd", "double",
        "if (c > 0 && d > 0) { double[] e = edges(a); double[] f = edges(b); if (few(e, f)) { double[] m = common(e, f); boolean sure = c == 2 && d == 2;"
        " if (sure || m[0] > 1e-9 * m[3]) return Double.valueOf(m[0]); } }"
        " Geometry g = in(a); Geometry h = in(b); if (!g.intersects(h)) return Double.valueOf(0);"
        " return Double.valueOf(over(g, h, org.locationtech.jts.operation.overlayng.OverlayNG.INTERSECTION).getArea());",
    ),
    # Counts of pairs with a shared area of more than c and the sum of these areas, by the places of two members with the classes. Members (x0, y0, fid, x1, y1,
    # class, geometry, plain, starts, slice) come by x0; starts is 1 if x0 is in the cell, plus 2 if y0 is. If b is 1, pairs of one slice don't count.
    "totals": ("rdd", "array<struct<a: int, b: int, n: bigint, area: double>>", "return scala.jdk.javaapi.CollectionConverters.asScala(totals(a, b == 1, c)).toSeq();"),
    # 1 intersects, 2 touches, 4 contains, 8 within, added up. What a measured area leaves open is asked of the exact predicates.
    "relation": (
        "bbdd", "int",
        "if (c > 0 && d > 0) { double[] e = edges(a); double[] f = edges(b); if (few(e, f)) { double[] m = common(e, f);"
        " if (c == 2 && d == 2) { if (m[0] <= 0) return Integer.valueOf(contact(e, f) ? 3 : 0); return Integer.valueOf(1 + (m[0] == m[5] ? 4 : 0) + (m[0] == m[4] ? 8 : 0)); }"
        " double slack = 1e-9 * m[3]; if (m[0] > slack) { boolean has = m[5] - m[0] <= slack; boolean lies = m[4] - m[0] <= slack; if (!has && !lies) return Integer.valueOf(1);"
        " Geometry g = in(a); Geometry h = in(b); return Integer.valueOf(1 + (has && g.contains(h) ? 4 : 0) + (lies && g.within(h) ? 8 : 0)); } } }"
        " Geometry g = in(a); Geometry h = in(b); if (!g.intersects(h)) return Integer.valueOf(0);"
        " return Integer.valueOf(1 + (g.touches(h) ? 2 : 0) + (g.contains(h) ? 4 : 0) + (g.within(h) ? 8 : 0));",
    ),
    # For each geometry the place of the first one it is linked to by contact (or a distance up to b), directly or through others of the array.
    "roots": (
        "ad", "array<int>",
        "int n = a.getNumGeometries(); int[] up = new int[n]; int[] off = new int[n]; double[][] flat = new double[n][]; org.locationtech.jts.geom.Envelope[] e = new org.locationtech.jts.geom.Envelope[n];"
        " for (int i = 0; i < n; i++) { up[i] = i; e[i] = new org.locationtech.jts.geom.Envelope(a.getGeometryN(i).getEnvelopeInternal()); }"
        " for (int i = 1; i < n; i++) { org.locationtech.jts.geom.Envelope w = new org.locationtech.jts.geom.Envelope(e[i]); w.expandBy(b);"
        " for (int j = 0; j < i; j++) { if (!w.intersects(e[j])) continue; int p = root(up, i); int q = root(up, j); if (p == q) continue;"
        " if (near(a, i, j, b, off, flat)) { if (p < q) up[q] = p; else up[p] = q; } } }"
        " java.util.List r = new java.util.ArrayList(); for (int i = 0; i < n; i++) r.add(Integer.valueOf(root(up, i)));"
        " return scala.jdk.javaapi.CollectionConverters.asScala(r).toSeq();",
    ),
    "dimension": ("g", "int", "return Integer.valueOf(a.getDimension());"),
    "union_all": ("a", "binary", "return out(org.locationtech.jts.operation.overlayng.OverlayNGRobust.union(a));"),
    "subtract_in_order": (
        "gad", "struct",
        "int n = 0; for (int i = 0; i < b.getNumGeometries(); i++) { Geometry o = b.getGeometryN(i);"
        " if (a.intersects(o) && over(a, o, org.locationtech.jts.operation.overlayng.OverlayNG.INTERSECTION).getArea() > c) {"
        " n++; a = over(a, o, org.locationtech.jts.operation.overlayng.OverlayNG.DIFFERENCE); } }"
        " return org.apache.spark.sql.RowFactory.create(new Object[]{out(a), Integer.valueOf(n)});",
    ),
}

_JAVA = {"double": "DoubleType", "string": "StringType", "boolean": "BooleanType", "binary": "BinaryType", "int": "IntegerType"}


#: Java that only the function of that name needs.
_OWN = {
    "totals": """  static org.apache.spark.sql.Row[] rows(Object s) {
    return (org.apache.spark.sql.Row[]) scala.jdk.javaapi.CollectionConverters.asJava((scala.collection.Seq) s).toArray(new org.apache.spark.sql.Row[0]);
  }
  /** Edges that are not upright as low x, high x, y at the low x, slope and direction from place 6 on; before them their end, the end of all edges and the box. */
  static double[] spans(double[] e) {
    int n = (int) e[0];
    int k = 6;
    double[] s = new double[6 + n / 4 * 5];
    s[1] = n; s[2] = e[1]; s[3] = e[2]; s[4] = e[1]; s[5] = e[2];
    for (int i = 1; i < n; i += 4) {
      s[2] = Math.min(s[2], e[i]); s[3] = Math.min(s[3], e[i + 1]); s[4] = Math.max(s[4], e[i]); s[5] = Math.max(s[5], e[i + 1]);
      if (e[i] == e[i + 2]) continue;
      boolean back = e[i + 2] < e[i];
      s[k] = back ? e[i + 2] : e[i]; s[k + 1] = back ? e[i] : e[i + 2]; s[k + 2] = back ? e[i + 3] : e[i + 1];
      s[k + 3] = (e[i + 3] - e[i + 1]) / (e[i + 2] - e[i]); s[k + 4] = back ? 1 : -1; k += 5;
    }
    s[0] = k;
    return s;
  }
  /** The area of common, without the centroid, over spans. */
  static double lap(double[] s, double[] t) {
    int n = (int) s[0]; int m = (int) t[0];
    double oy = Math.min(s[3], t[3]); double two = 0;
    for (int i = 6; i < n; i += 5) {
      double lo = s[i]; double hi = s[i + 1]; double y = s[i + 2] - oy; double k = s[i + 3]; double part = 0;
      for (int j = 6; j < m; j += 5) {
        double from = t[j]; double u = lo > from ? lo : from; double v = hi < t[j + 1] ? hi : t[j + 1];
        if (u >= v) continue;
        double z = t[j + 2] - oy; double l = t[j + 3];
        double p = y + k * (u - lo); double q = y + k * (v - lo); double r = z + l * (u - from); double x = z + l * (v - from);
        double g = p - r; double h = q - x; double w = v - u;
        if ((g < 0 && h > 0) || (g > 0 && h < 0)) {
          double d = g * w / (g - h); double c = p + (q - p) * d / w;
          part += t[j + 4] * (d * (c + (g < 0 ? p : r)) + (w - d) * (c + (h < 0 ? q : x)));
        } else part += t[j + 4] * w * ((g < 0 ? p : r) + (h < 0 ? q : x));
      }
      two += s[i + 4] * part;
    }
    return two / 2;
  }
  /** The area of shared for outlines i and j; those that were read for an overlay are kept in read. */
  static double lap(int i, int j, double[][] spans, int[] plain, byte[][] w, Geometry[] read) throws Exception {
    double[] s = spans[i]; double[] t = spans[j];
    if (s != null && t != null && s[1] * t[1] <= 65536) {
      double area = lap(s, t);
      if (plain[i] == 2 && plain[j] == 2) return area;
      if (area > 1e-9 * (Math.max(s[4], t[4]) - Math.min(s[2], t[2])) * (Math.max(s[5], t[5]) - Math.min(s[3], t[3]))) return area;
    }
    if (read[i] == null) read[i] = in(w[i]);
    if (read[j] == null) read[j] = in(w[j]);
    return read[i].intersects(read[j]) ? over(read[i], read[j], org.locationtech.jts.operation.overlayng.OverlayNG.INTERSECTION).getArea() : 0;
  }
  /** Equal outlines are measured as one, with the number of their members by class; not where an id is repeated, as a feature is no pair with itself. */
  static java.util.List totals(org.apache.spark.sql.Row[] rows, boolean cross, double least) throws Exception {
    int size = rows.length; int n = 0; int[] start = new int[size]; int[] slice = new int[size]; int[] plain = new int[size];
    double[] x0 = new double[size]; double[] y0 = new double[size]; double[] x1 = new double[size]; double[] y1 = new double[size];
    byte[][] w = new byte[size][]; double[][] spans = new double[size][]; Geometry[] read = new Geometry[size]; Object[] fid = new Object[size];
    int[][] cls = new int[size][]; long[][] many = new long[size][]; int[] place = new int[size];
    java.util.HashSet fids = new java.util.HashSet();
    for (int i = 0; i < size; i++) fids.add(rows[i].get(2));
    boolean once = fids.size() == size;
    java.util.HashMap known = new java.util.HashMap(); java.util.HashMap named = new java.util.HashMap();
    for (int i = 0; i < size; i++) {
      org.apache.spark.sql.Row r = rows[i];
      if (r.isNullAt(6) || r.isNullAt(7)) continue;
      Integer c = (Integer) named.get(r.get(5));
      if (c == null) { c = Integer.valueOf(named.size()); place[c.intValue()] = i; named.put(r.get(5), c); }
      x0[n] = r.getDouble(0); y0[n] = r.getDouble(1); x1[n] = r.getDouble(3); y1[n] = r.getDouble(4);
      w[n] = (byte[]) r.get(6); plain[n] = r.getInt(7); start[n] = r.getInt(8); slice[n] = r.getInt(9);
      java.nio.ByteBuffer key = java.nio.ByteBuffer.wrap(w[n]);
      Integer had = once ? (Integer) known.get(key) : null;
      int k = had == null ? n : had.intValue();
      if (k < n && (x0[k] != x0[n] || y0[k] != y0[n] || x1[k] != x1[n] || y1[k] != y1[n] || slice[k] != slice[n])) k = n;
      if (k == n) {
        if (plain[n] > 0) spans[n] = spans(edges(w[n]));
        fid[n] = r.get(2); cls[n] = new int[0]; many[n] = new long[0]; known.put(key, Integer.valueOf(n)); n++;
      }
      int p = 0;
      while (p < cls[k].length && cls[k][p] != c.intValue()) p++;
      if (p == cls[k].length) { cls[k] = java.util.Arrays.copyOf(cls[k], p + 1); many[k] = java.util.Arrays.copyOf(many[k], p + 1); cls[k][p] = c.intValue(); }
      many[k][p]++;
    }
    int kinds = named.size(); long[] count = new long[kinds]; double[] area = new double[kinds]; int[] met = new int[kinds];
    java.util.HashMap sums = new java.util.HashMap();
    for (int i = 0; i < n; i++) {
      int m = 0;
      for (int j = i + 1; j < n && x0[j] <= x1[i]; j++) {
        if ((start[i] | start[j]) != 3 || y0[j] > y1[i] || y0[i] > y1[j] || (cross && slice[i] == slice[j]) || (!once && fid[i].equals(fid[j]))) continue;
        double s = lap(i, j, spans, plain, w, read);
        if (!(s > least)) continue;
        for (int p = 0; p < cls[j].length; p++) { int c = cls[j][p]; if (count[c] == 0) met[m++] = c; count[c] += many[j][p]; area[c] += many[j][p] * s; }
      }
      for (int p = 0; p < cls[i].length; p++) for (int q = 0; q < m; q++) add(sums, cls[i][p], met[q], many[i][p] * count[met[q]], many[i][p] * area[met[q]]);
      for (int q = 0; q < m; q++) { count[met[q]] = 0; area[met[q]] = 0; }
      if (cross || start[i] != 3 || (cls[i].length == 1 && many[i][0] == 1)) continue;
      double s = lap(i, i, spans, plain, w, read);
      if (s > least) for (int p = 0; p < cls[i].length; p++) for (int q = p; q < cls[i].length; q++) {
        long k = q == p ? many[i][p] * (many[i][p] - 1) / 2 : many[i][p] * many[i][q];
        if (k > 0) add(sums, cls[i][p], cls[i][q], k, k * s);
      }
    }
    java.util.List out = new java.util.ArrayList();
    java.util.Iterator every = sums.values().iterator();
    while (every.hasNext()) {
      double[] t = (double[]) every.next();
      out.add(org.apache.spark.sql.RowFactory.create(new Object[]{Integer.valueOf(place[(int) t[0]]), Integer.valueOf(place[(int) t[1]]), Long.valueOf((long) t[2]), Double.valueOf(t[3])}));
    }
    return out;
  }
  static void add(java.util.Map sums, int a, int b, long n, double area) {
    Long key = Long.valueOf(((long) Math.min(a, b) << 32) + Math.max(a, b));
    double[] t = (double[]) sums.get(key);
    if (t == null) { t = new double[]{Math.min(a, b), Math.max(a, b), 0, 0}; sums.put(key, t); }
    t[2] += n; t[3] += area;
  }
""",
}


def _source(name: str, kinds: str, body: str) -> str:
    raw = ", ".join(f"Object {v}0" for v in "abcd"[: len(kinds)])
    guards = " || ".join(f"{v}0 == null" for v in "abcd"[: len(kinds)])
    reads = {"g": "Geometry {v} = in({v}0);", "d": "double {v} = ((Number) {v}0).doubleValue();", "s": "String {v} = (String) {v}0;", "a": "Geometry {v} = all({v}0);", "b": "byte[] {v} = (byte[]) {v}0;", "r": "org.apache.spark.sql.Row[] {v} = rows({v}0);"}
    lines = "\n    ".join(reads[k].format(v=v) for k, v in zip(kinds, "abcd", strict=False))
    return f"""package {_PKG};
import org.locationtech.jts.geom.Geometry;
public class G_{name} implements org.apache.spark.sql.api.java.UDF{len(kinds)} {{
  static Geometry in(Object w) throws Exception {{ return new org.locationtech.jts.io.WKBReader().read((byte[]) w); }}
  static byte[] out(Geometry g) {{ return new org.locationtech.jts.io.WKBWriter().write(g); }}
  static Geometry over(Geometry x, Geometry y, int op) {{ return org.locationtech.jts.operation.overlayng.OverlayNGRobust.overlay(x, y, op); }}
  static Geometry all(Object s) throws Exception {{
    java.util.List r = new java.util.ArrayList();
    java.util.Iterator i = scala.jdk.javaapi.CollectionConverters.asJava((scala.collection.Iterable) s).iterator();
    while (i.hasNext()) {{ Object w = i.next(); if (w != null) r.add(in(w)); }}
    return new org.locationtech.jts.geom.GeometryFactory().createGeometryCollection((Geometry[]) r.toArray(new Geometry[0]));
  }}
  static void turn(org.locationtech.jts.geom.LineString r, boolean ccw) {{
    org.locationtech.jts.geom.CoordinateSequence s = r.getCoordinateSequence();
    if (s.size() > 3 && org.locationtech.jts.algorithm.Orientation.isCCW(s) != ccw) org.locationtech.jts.geom.CoordinateSequences.reverse(s);
  }}
  static int root(int[] up, int i) {{ while (up[i] != i) {{ up[i] = up[up[i]]; i = up[i]; }} return i; }}
  static void turned(java.nio.ByteBuffer r) {{ r.order(r.get() == 0 ? java.nio.ByteOrder.BIG_ENDIAN : java.nio.ByteOrder.LITTLE_ENDIAN); }}
  /** Edges x1, y1, x2, y2 of plain polygons from place 1 on, the inside to their left; place 0 has the end. */
  static double[] edges(byte[] w) {{
    java.nio.ByteBuffer r = java.nio.ByteBuffer.wrap(w);
    double[] e = new double[w.length / 4 + 1];
    int n = 1;
    int parts = 1;
    turned(r);
    boolean many = r.getInt() == 6;
    if (many) parts = r.getInt();
    for (int p = 0; p < parts; p++) {{
      if (many) {{ turned(r); r.getInt(); }}
      int rings = r.getInt();
      for (int k = 0; k < rings; k++) {{
        int m = r.getInt();
        int from = n;
        if (m == 0) continue;
        double x0 = r.getDouble(); double y0 = r.getDouble(); double px = x0; double py = y0; double s = 0;
        for (int i = 1; i < m; i++) {{
          double x = r.getDouble(); double y = r.getDouble();
          s += (px - x0) * (y - y0) - (x - x0) * (py - y0);
          e[n] = px; e[n + 1] = py; e[n + 2] = x; e[n + 3] = y; n += 4; px = x; py = y;
        }}
        if ((s > 0) != (k == 0)) for (int i = from; i < n; i += 4) {{
          double x = e[i]; e[i] = e[i + 2]; e[i + 2] = x; double y = e[i + 1]; e[i + 1] = e[i + 3]; e[i + 3] = y;
        }}
      }}
    }}
    e[0] = n;
    return e;
  }}
  static boolean few(double[] e, double[] f) {{ return e[0] * f[0] <= 65536; }}
  /** What two outlines share: area, x and y of its centroid, area of the box around both, area of each. Sums over pairs of edges of what lies below both. */
  static double[] common(double[] e, double[] f) {{
    int n = (int) e[0]; int m = (int) f[0];
    double ox = e[1]; double oy = e[2]; double mx = ox; double my = oy;
    for (int i = 1; i < n; i += 4) {{ ox = Math.min(ox, e[i]); mx = Math.max(mx, e[i]); oy = Math.min(oy, e[i + 1]); my = Math.max(my, e[i + 1]); }}
    for (int i = 1; i < m; i += 4) {{ ox = Math.min(ox, f[i]); mx = Math.max(mx, f[i]); oy = Math.min(oy, f[i + 1]); my = Math.max(my, f[i + 1]); }}
    double ea = 0; double fa = 0; double two = 0; double sx = 0; double sy = 0;
    for (int i = 1; i < n; i += 4) ea += (e[i] - e[i + 2]) * (e[i + 1] - oy + e[i + 3] - oy);
    for (int i = 1; i < m; i += 4) fa += (f[i] - f[i + 2]) * (f[i + 1] - oy + f[i + 3] - oy);
    for (int i = 1; i < n; i += 4) {{
      double ax = e[i]; double bx = e[i + 2];
      if (ax == bx) continue;
      double ay = e[i + 1]; double ty = e[i + 3] - ay; double tx = bx - ax;
      double lo = Math.min(ax, bx); double hi = Math.max(ax, bx);
      for (int j = 1; j < m; j += 4) {{
        double cx = f[j]; double dx = f[j + 2];
        double u = Math.max(lo, Math.min(cx, dx)); double v = Math.min(hi, Math.max(cx, dx));
        if (u >= v) continue;
        double cy = f[j + 1]; double uy = f[j + 3] - cy; double ux = dx - cx;
        double p = ty == 0 ? ay - oy : ay - oy + ty * (u - ax) / tx; double q = ty == 0 ? p : ay - oy + ty * (v - ax) / tx;
        double s = uy == 0 ? cy - oy : cy - oy + uy * (u - cx) / ux; double t = uy == 0 ? s : cy - oy + uy * (v - cx) / ux;
        double sign = (bx < ax) == (dx < cx) ? 1 : -1;
        double g = p - s; double h = q - t; double w = v - u; double k = u - ox;
        if ((g < 0 && h > 0) || (g > 0 && h < 0)) {{
          double z = g * w / (g - h); double r = p + (q - p) * z / w;
          double l = Math.min(p, s);
          two += sign * z * (l + r); sx += sign * z * (3 * k * (l + r) + z * (l + 2 * r)); sy += sign * z * (l * l + l * r + r * r);
          k += z; w -= z; l = Math.min(q, t);
          two += sign * w * (r + l); sx += sign * w * (3 * k * (r + l) + w * (r + 2 * l)); sy += sign * w * (l * l + l * r + r * r);
        }} else {{
          double l = Math.min(p, s); double r = Math.min(q, t);
          two += sign * w * (l + r); sx += sign * w * (3 * k * (l + r) + w * (l + 2 * r)); sy += sign * w * (l * l + l * r + r * r);
        }}
      }}
    }}
    return new double[]{{two / 2, ox + sx / (3 * two), oy + sy / (3 * two), (mx - ox) * (my - oy), ea / 2, fa / 2}};
  }}
  static boolean whole(double[] e) {{
    for (int i = 1; i < e[0]; i += 4) {{
      double dx = Math.abs(e[i + 2] - e[i]); double dy = Math.abs(e[i + 3] - e[i + 1]);
      if (e[i] != Math.rint(e[i]) || e[i + 1] != Math.rint(e[i + 1]) || Math.abs(e[i]) >= 1048576 || Math.abs(e[i + 1]) >= 1048576 || (dx != 0 && dy != 0 && dx != dy)) return false;
    }}
    return true;
  }}
  /** Members i and j of a are at most d apart. What missed others twice is from then on measured by its edges, kept in flat, if these are exact. */
  static boolean near(Geometry a, int i, int j, double d, int[] off, double[][] flat) {{
    Geometry g = a.getGeometryN(i); Geometry h = a.getGeometryN(j);
    if (d > 0) return g.isWithinDistance(h, d);
    if (flat[i] != null && flat[j] != null && flat[i].length > 0 && flat[j].length > 0 && few(flat[i], flat[j])) return contact(flat[i], flat[j]) || common(flat[i], flat[j])[0] > 0;
    if (g.intersects(h)) return true;
    for (int k = 0; k < 2; k++) {{
      int n = k == 0 ? i : j; Geometry x = k == 0 ? g : h;
      if (++off[n] != 2) continue;
      flat[n] = new double[0];
      if (x instanceof org.locationtech.jts.geom.Polygonal && x.isValid()) {{ double[] e = edges(out(x)); if (whole(e)) flat[n] = e; }}
    }}
    return false;
  }}
  static double side(double ax, double ay, double bx, double by, double cx, double cy) {{ return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax); }}
  /** Some edges of the two meet; exact on whole numbers. */
  static boolean contact(double[] e, double[] f) {{
    for (int i = 1; i < e[0]; i += 4) for (int j = 1; j < f[0]; j += 4) {{
      double ax = e[i]; double ay = e[i + 1]; double bx = e[i + 2]; double by = e[i + 3]; double cx = f[j]; double cy = f[j + 1]; double dx = f[j + 2]; double dy = f[j + 3];
      if (Math.max(ax, bx) < Math.min(cx, dx) || Math.max(cx, dx) < Math.min(ax, bx) || Math.max(ay, by) < Math.min(cy, dy) || Math.max(cy, dy) < Math.min(ay, by)) continue;
      if (side(ax, ay, bx, by, cx, cy) * side(ax, ay, bx, by, dx, dy) <= 0 && side(cx, cy, dx, dy, ax, ay) * side(cx, cy, dx, dy, bx, by) <= 0) return true;
    }}
    return false;
  }}
{_OWN.get(name, "")}  public Object call({raw}) throws Exception {{
    if ({guards}) return null;
    {lines}
    {body}
  }}
}}
"""


def ensure(spark: SparkSession) -> None:
    """Makes the kernel's functions (``geo_<name>``) known to the session."""
    if spark.conf.get("terraloom.kernel", None):
        return
    jvm = spark._jvm
    packed = io.BytesIO()
    loader = jvm.Thread.currentThread().getContextClassLoader()
    made = {}
    with zipfile.ZipFile(packed, "w") as z:
        for name, (kinds, _, body) in _OPS.items():
            compiler = jvm.org.codehaus.janino.SimpleCompiler()
            compiler.setParentClassLoader(loader)
            compiler.cook(_source(name, kinds, body))
            codes = compiler.getBytecodes()
            for cls in codes:
                z.writestr(cls.replace(".", "/") + ".class", bytes(codes[cls]))
            made[name] = compiler.getClassLoader().loadClass(f"{_PKG}.G_{name}").newInstance()
    jar = store(spark, f"terraloom-kernel-{uuid.uuid4().hex}.jar", packed.getvalue())
    spark.sql(f"ADD JAR '{jar}'")
    types = jvm.org.apache.spark.sql.types.DataType
    for name, (_, result, _) in _OPS.items():
        if result in _JAVA:
            kind = getattr(jvm.org.apache.spark.sql.types.DataTypes, _JAVA[result])
        elif result == "struct":
            kind = types.fromDDL("geom binary, n int")
        else:
            kind = types.fromDDL(f"v {result}").fields()[0].dataType()
        spark._jsparkSession.udf().register(f"geo_{name}", made[name], kind)
    spark.conf.set("terraloom.kernel", "ready")


def geo(name: str, *args: Column | str | float) -> Column:
    """Call of a kernel function; floats become literals."""
    if name not in _OPS:
        raise KeyError(name)
    cols = [F.lit(a) if isinstance(a, int | float) else F.col(a) if isinstance(a, str) else a for a in args]
    return F.call_function(f"geo_{name}", *cols)


def with_bounds(df, geom: str = "geom"):
    """Adds the bounding box columns x0, y0, x1, y1 of a geometry column."""
    return df.withColumns({k: geo(k, geom) for k in ("x0", "y0", "x1", "y1")})
