"""Which tables are synced, from where to where, and how."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class SyncTask:
    """``mode`` is full, keep_if_empty, append or incremental (by ``column``; with ``keys`` rows are
    upserted, without they are appended). ``partition_by`` is a date column of the source; a keyed load rewrites only
    the dates that hold one of its keys, and a row whose date has changed moves. ``partition_follows`` says that a
    key's date never changes, which spares looking the keys up. Rows whose ``column`` is null come with the first run
    only: nothing tells that they are new."""

    source: str
    target: str
    mode: str = "full"
    column: str | None = None
    keys: tuple[str, ...] = ()
    group: str = "daily"
    partition_by: str | None = None
    partition_follows: bool = False


# The tables of the daily sync, in sync order.
DAILY_TABLES = """
alert_geofence armada_perangkat armada_tms atribut atribut_produk attachment attachment_armada
attachment_chat attachment_driver attachment_gudang attachment_pengembalian attachment_perangkat
attachment_qc bank chat_room customers daftar_user delivery_order detail_do detail_po detail_qc
detail_sm detail_so driver_armada geofence gudang jenis_armada jenis_file jenis_insiden
jenis_notifikasi jenis_order jenis_satuan jenis_transaksi kategori_produk kontak_darurat konversi
kriteria_produk language language_text laporan_darurat laporan_pengemudi locations
log_aktifitas_driver log_chat log_panggilan log_perangkat log_perjalanan_armada log_sensor
log_service lokasi_rak mata_uang metode_pembayaran notifikasi order_tms orders parent_armada
pembayaran_fee pengembalian pengingat_pemeliharaan_armada perangkat perangkat_gps_driver produk
produk_gudang purchase_order quality_control rating rekening_driver role room_last_read
room_members rute rute_perangkat sales_order satuan status_armada status_gudang status_order
status_qc status_user stok stok_movement suppliers tempat_istirahat_driver tenant units user_role
user_tenant weather z_test
""".split()

# The on-demand sync; one table changes its name.
ON_DEMAND_TABLES = {
    "jenis_armada": "jenis_armada",
    "driver_armada": "driver_armada",
    "rating": "rating",
    "delivery_order": "orders",
    "perangkat_gps_driver": "perangkat_gps_driver",
    "rekening_driver": "rekening_driver",
}

# The tables of the append-only extract.
APPEND_TABLES = """
driver_armada armada rating log_perjalanan_armada log_aktifitas_driver delivery_order driver
""".split()

# The driver KPI sync: master tables in full, the others by their stamp column.
KPI_MASTER = ("driver", "armada", "driver_armada", "perangkat_gps_driver", "rekening_driver")
KPI_OPERATIONAL = {"delivery_order": "updated_at", "rating": "updated_at"}
KPI_LOGS = {"log_aktifitas_driver": "created_at", "log_perjalanan_armada": "created_at"}


def daily_manifest() -> list[SyncTask]:
    return [SyncTask(name, name) for name in DAILY_TABLES]


def on_demand_manifest() -> list[SyncTask]:
    return [SyncTask(s, t, "keep_if_empty", group="on_demand") for s, t in ON_DEMAND_TABLES.items()]


def append_manifest() -> list[SyncTask]:
    return [SyncTask(name, name, "append", group="append") for name in APPEND_TABLES]


def kpi_manifest() -> list[SyncTask]:
    tasks = [SyncTask(name, name, group="master") for name in KPI_MASTER]
    tasks += [
        SyncTask(name, name, "incremental", column, group="operational")
        for name, column in KPI_OPERATIONAL.items()
    ]
    tasks += [SyncTask(name, name, "incremental", column, group="log") for name, column in KPI_LOGS.items()]
    return tasks


def one_namespace(tasks: Iterable[SyncTask]) -> list[SyncTask]:
    """The tasks, refused when two of them would write one target."""
    tasks = list(tasks)
    targets = [task.target for task in tasks]
    clashes = sorted({name for name in targets if targets.count(name) > 1})
    if clashes:
        raise ValueError(f"several sources for {', '.join(clashes)}")
    return tasks
