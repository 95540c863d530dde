"""Raw views and the warehouse tables as SQL over the driver's tables.

Written apart from the Spark code, so that agreement between the two means
something. ``with_views`` puts the views a query needs in front of it.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "raw_transactions": """
WITH b AS (
  SELECT o_orderkey, CAST(o_orderkey AS STRING) AS transaction_id,
    CONCAT('NATION_', CAST(c_nationkey AS STRING)) AS outlet_id,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS customer_id,
    CASE WHEN o_orderkey % 7 = 0
         THEN CONCAT(REPLACE(CAST(o_orderdate + INTERVAL '20' HOUR AS STRING), ' ', 'T'), 'Z')
         ELSE CAST(o_orderdate AS STRING) END AS tanggal_waktu,
    CASE o_orderstatus
      WHEN 'F' THEN CASE WHEN o_orderkey % 3 = 0 THEN ' paid ' ELSE 'PAID' END
      WHEN 'O' THEN CASE WHEN o_orderkey % 5 = 0 THEN 'VOID' ELSE 'PENDING' END
      ELSE 'PARTIAL' END AS status,
    CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS total_bayar
  FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT transaction_id, outlet_id, customer_id, tanggal_waktu, status, total_bayar FROM b
UNION ALL
SELECT transaction_id, outlet_id, customer_id, tanggal_waktu, status, total_bayar FROM b WHERE o_orderkey % 71 = 0
UNION ALL
SELECT transaction_id, outlet_id, customer_id, tanggal_waktu, 'CANCELLED', total_bayar FROM b WHERE o_orderkey % 97 = 0
""",
    "raw_transaction_items": """
SELECT CAST(l_orderkey AS STRING) AS transaction_id, CAST(l_linenumber AS STRING) AS item_id,
  CASE WHEN l_orderkey % 503 = 0 THEN 'PRD-X' ELSE CONCAT('PRD-', CAST(l_partkey AS STRING)) END AS product_id,
  CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -1 ELSE 1 END * CAST(l_quantity AS INT) AS STRING) AS qty,
  CAST(CAST(FLOOR(l_extendedprice / l_quantity + 0.000001) AS INT) AS STRING) AS harga_satuan,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS STRING)
    AS diskon
FROM lineitem
""",
    "raw_products": """
SELECT CONCAT('PRD-', CAST(p_partkey AS STRING)) AS product_id, p_name AS nama_produk, p_type AS kategori,
  CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS STRING) AS harga_satuan,
  CASE WHEN p_partkey % 10 = 9 THEN '1996-06-01' ELSE '1995-01-01' END AS harga_berlaku_dari,
  CASE WHEN p_partkey % 8 = 0 THEN ' Tidak' ELSE 'YA ' END AS aktif
FROM part
UNION ALL
SELECT CONCAT('PRD-', CAST(p_partkey AS STRING)), p_name, p_type,
  CAST(CAST(CAST(p_retailprice AS DECIMAL(15,2)) + 50 AS DECIMAL(15,2)) AS STRING), '1998-01-01', 'ya'
FROM part WHERE p_partkey % 4 = 0
UNION ALL
SELECT CONCAT('PRD-', CAST(p_partkey AS STRING)), p_name, p_type,
  CAST(CAST(CAST(p_retailprice AS DECIMAL(15,2)) + 75 AS DECIMAL(15,2)) AS STRING), NULL, 'ya'
FROM part WHERE p_partkey % 50 = 7 OR p_partkey % 50 = 8
""",
    "raw_outlets": """
SELECT n_name AS outlet_id, n_name AS nama_outlet, r_name AS kota, 'outlet' AS tipe,
  CASE WHEN n_nationkey = 24 THEN 'tidak' ELSE 'ya' END AS aktif, '1995-01-01' AS dibuka_sejak
FROM nation JOIN region ON r_regionkey = n_regionkey
""",
    "raw_mahasiswa": """
SELECT CAST(c_custkey AS STRING) AS nim, c_name AS nama,
  CASE WHEN c_custkey % 43 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN '2024'
       WHEN c_custkey % 3 = 1 THEN '2023' ELSE '2022' END AS angkatan,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE LOWER(c_mktsegment) END AS status
FROM customer
""",
    "raw_presensi": """
SELECT CAST(user_id AS STRING) AS nim, event_type AS kode_mk,
  CASE WHEN event_id % 20 = 0
       THEN CONCAT(SUBSTR(CAST(ts AS STRING),9,2),'/',SUBSTR(CAST(ts AS STRING),6,2),'/',SUBSTR(CAST(ts AS STRING),1,4))
       ELSE SUBSTR(CAST(ts AS STRING),1,10) END AS tanggal,
  CASE event_type WHEN 'view' THEN 'Hadir ' WHEN 'click' THEN 'h' WHEN 'signup' THEN 'IZIN'
       WHEN 'error' THEN 'sakit' ELSE 'telat' END AS status
FROM events
""",
    "raw_nilai": """
SELECT CAST(user_id AS STRING) AS nim, event_type AS kode_mk,
  CASE WHEN event_id % 501 = 0 THEN '-5' WHEN event_id % 503 = 0 THEN 'abc'
       ELSE CAST(CAST(FLOOR(value) AS INT) AS STRING) END AS nilai_angka
FROM events
""",
    "raw_prakiraan_cuaca": """
SELECT CAST(user_id AS STRING) AS adm4,
  CONCAT(SUBSTR(CAST(ts AS STRING),1,13),':00:00') AS local_datetime,
  CONCAT(SUBSTR(CAST(ts - CASE WHEN user_id % 5 = 0 THEN INTERVAL '8' HOUR ELSE INTERVAL '7' HOUR END AS STRING),1,13),
    ':00:00') AS utc_datetime,
  CASE WHEN value < 20 THEN '0' WHEN event_id % 997 = 0 THEN '-1' ELSE CAST(CAST(FLOOR(value) AS INT) AS STRING) END AS tp,
  CASE WHEN event_id % 2 = 0 THEN '' ELSE NULL END AS vs,
  CASE event_type WHEN 'view' THEN '0' WHEN 'click' THEN '1' WHEN 'signup' THEN '2' WHEN 'error' THEN '61' ELSE '3' END
    AS weather,
  CASE event_type WHEN 'view' THEN 'Cerah' WHEN 'click' THEN 'Cerah' WHEN 'signup' THEN 'Cerah Berawan'
       WHEN 'error' THEN 'Hujan Ringan' ELSE 'Berawan' END AS weather_desc,
  CONCAT(CAST(event_id % 37 AS STRING),'-',CAST(event_id % 37 + 1 AS STRING)) AS time_index,
  SUBSTR(CAST(ts AS STRING),1,10) AS analysis_date
FROM events
""",
    "raw_desa": """
SELECT CAST(n_nationkey AS STRING) AS kode, n_name AS desa, r_name AS kecamatan
FROM nation JOIN region ON r_regionkey = n_regionkey
""",
    # The status dictionary and the Unknown members.
    "status_dictionary": """
SELECT * FROM (VALUES
  (1, 'CANCELLED', 'Dibatalkan', 'batal', FALSE),
  (2, 'PAID', 'Lunas / Dibayar', 'selesai', TRUE),
  (3, 'PARTIAL', 'Pembayaran Sebagian', 'proses', FALSE),
  (4, 'PENDING', 'Menunggu Pembayaran', 'proses', FALSE),
  (5, 'REFUNDED', 'Dikembalikan / Retur', 'batal', FALSE),
  (-1, 'UNKNOWN', 'TIDAK DIKETAHUI', 'tidak diketahui', FALSE)
) AS v(status_sk, status_code, label_indonesia, kategori_final, berdampak_pendapatan)
""",
    "price_history": """
SELECT CAST(row_number() OVER (ORDER BY product_id NULLS LAST, harga_berlaku_dari NULLS LAST, nama_produk NULLS LAST,
    kategori NULLS LAST, harga_satuan NULLS LAST, aktif NULLS LAST) AS BIGINT) AS product_sk,
  product_id, nama_produk, kategori, CAST(harga_satuan AS DOUBLE) AS harga_satuan,
  COALESCE(CAST(harga_berlaku_dari AS DATE), DATE '1995-01-01') AS valid_from,
  CAST(COALESCE(CAST(lead(harga_berlaku_dari) OVER later AS DATE) - 1, DATE '9999-12-31') AS DATE) AS valid_to,
  lead(harga_berlaku_dari) OVER later IS NULL AS is_current,
  LOWER(TRIM(aktif)) = 'ya' AS is_aktif
FROM raw_products
WINDOW later AS (PARTITION BY product_id ORDER BY harga_berlaku_dari NULLS LAST)
UNION ALL
SELECT -1, 'PRD-UNKNOWN', 'TIDAK DIKETAHUI', 'TIDAK DIKETAHUI', 0, DATE '1900-01-01', DATE '9999-12-31', TRUE, FALSE
""",
    "outlet_master": """
SELECT CAST(row_number() OVER (ORDER BY outlet_id NULLS LAST) AS BIGINT) AS outlet_sk, outlet_id, nama_outlet, kota, tipe,
  LOWER(TRIM(aktif)) = 'ya' AS is_aktif, CAST(dibuka_sejak AS DATE) AS dibuka_sejak
FROM raw_outlets
UNION ALL
SELECT -1, 'OUT-UNKNOWN', 'TIDAK DIKETAHUI', 'TIDAK DIKETAHUI', 'TIDAK DIKETAHUI', FALSE, DATE '1900-01-01'
""",
    # Headers on which every checked field has one value: the distinct field
    # combinations of an id are few, so look at the ids with a single one.
    "clean_headers": """
SELECT transaction_id, any_value(outlet_id) AS outlet_id, any_value(tanggal_waktu) AS tanggal_waktu,
  any_value(status) AS status, any_value(total_bayar) AS total_bayar
FROM (SELECT DISTINCT transaction_id, outlet_id, tanggal_waktu, status, total_bayar FROM raw_transactions)
GROUP BY transaction_id
HAVING count(DISTINCT outlet_id) = 1 AND count(DISTINCT tanggal_waktu) = 1
   AND count(DISTINCT status) = 1 AND count(DISTINCT total_bayar) = 1
""",
    "lines": """
SELECT i.*, h.outlet_id, h.status, h.total_bayar, CAST(h.tanggal_waktu AS DATE) AS tgl
FROM (SELECT DISTINCT * FROM raw_transaction_items) AS i
JOIN clean_headers AS h ON h.transaction_id = i.transaction_id
""",
    # One row per fact line, with the dimension attributes the reports use.
    "fact": """
SELECT
  COALESCE(CAST(strftime(l.tgl, '%Y%m%d') AS INT), -1) AS date_sk,
  COALESCE(v.product_sk, -1) AS product_sk, COALESCE(o.outlet_sk, -1) AS outlet_sk,
  COALESCE(s.status_sk, -1) AS status_sk,
  l.transaction_id, l.item_id, CAST(l.qty AS INT) AS qty,
  CAST(l.harga_satuan AS DECIMAL(15,2)) AS harga_satuan_aktual,
  CAST(l.diskon AS DECIMAL(15,2)) AS diskon,
  CAST(l.qty AS INT) * CAST(l.harga_satuan AS DECIMAL(15,2)) - CAST(l.diskon AS DECIMAL(15,2)) AS subtotal_rupiah,
  CAST(l.total_bayar AS DECIMAL(15,2)) AS total_bayar_trx,
  l.outlet_id, l.tgl, s.status_code, s.kategori_final
FROM lines AS l
LEFT JOIN price_history AS v ON v.product_id = l.product_id AND l.tgl BETWEEN v.valid_from AND v.valid_to
LEFT JOIN outlet_master AS o ON o.outlet_id = l.outlet_id
LEFT JOIN status_dictionary AS s ON s.status_code = UPPER(TRIM(l.status))
""",
    # Lines of the three reported outlets in the reported year.
    "reported": """
SELECT *, CAST(year(tgl) AS INT) AS tahun, CAST(quarter(tgl) AS INT) AS triwulan, CAST(month(tgl) AS INT) AS bulan
FROM fact WHERE outlet_id IN ('NATION_0', 'NATION_1', 'NATION_2') AND date_sk BETWEEN 19970101 AND 19971231
""",
}


def _needed(sql: str, have: set[str]) -> list[str]:
    """Views named in ``sql``, each after the views it names itself."""
    order: list[str] = []
    for name, text in VIEWS.items():
        if name not in have and re.search(rf"\b{name}\b", sql):
            order.extend(_needed(text, have | set(order) | {name}))
            order.append(name)
    return list(dict.fromkeys(order))


def with_views(sql: str) -> str:
    needed = _needed(sql, set())
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    return f"WITH {views}\n{sql.strip()}"
