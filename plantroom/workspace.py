"""The library's operators bound to the entity tables of one storage root."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plantroom.functions.columns import col, filter_by_ids, flatten
from plantroom.operators import bucketed, catalog, metadata, selection, staging, timeseries
from plantroom.operators.catalog import Ids
from plantroom.operators.timeseries import Moment
from plantroom.session import configure
from plantroom.sources.tables import read_table, replace_partitions
from plantroom.sources.uploads import read_upload_csv

Buildings = Sequence[int | str] | int | str


class Workspace:
    """Getters and staging operations over a set of entity tables.

    Everything returned is a lazy DataFrame. Staging operations return the new
    tables instead of overwriting the old ones; :meth:`write_building` writes one
    building's part of them back.

    ``unique_readings`` states that no point has two readings of one time. Wide
    tables then need no sort of readings (``unique_order``).
    """

    def __init__(self, tables: Mapping[str, DataFrame], unique_readings: bool = False):
        self._tables = dict(tables)
        self._unique_readings = unique_readings
        self._spark: SparkSession | None = None
        self._root = ""
        self._schemas: dict[str, StructType | str] = {}

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        root: str,
        schemas: Mapping[str, StructType | str] | None = None,
        unique_readings: bool = False,
    ) -> "Workspace":
        """Tables are Parquet directories under ``root``, read when first needed.

        ``schemas`` states the columns of entities, so that no file is opened to
        find them out; worth it for readings in very many files.
        """
        workspace = cls({}, unique_readings)
        workspace._spark, workspace._root, workspace._schemas = configure(spark), root, dict(schemas or {})
        return workspace

    def table(self, entity: str) -> DataFrame:
        if entity not in self._tables:
            if self._spark is None:
                raise KeyError(f"this workspace has no table '{entity}'")
            self._tables[entity] = read_table(self._spark, self._root, entity, self._schemas.get(entity))
        return self._tables[entity]

    # tables kept by building: "staged" (flat rows of the staging view) and "live"

    def read_building(self, entity: str, building: Buildings) -> DataFrame:
        """The rows of one building; a building given by id needs no list of buildings."""
        return filter_by_ids(self.table(entity), "building_id", self._one(building))

    def write_building(self, entity: str, building: Buildings, rows: DataFrame) -> None:
        """Replace a building's rows on storage; other buildings' files are left alone.

        The table is partitioned by ``building_id``. ``rows`` may be made from it, such as the result of an upload or
        a promotion of :meth:`read_building`; rows that are new and name no building become this one's.
        """
        if entity not in ("staged", "live"):
            raise ValueError("only the tables 'staged' and 'live' are kept by building")
        if self._spark is None:
            raise ValueError("this workspace is not on storage")
        here = self._one(building)
        named = rows.columns if "building_id" in rows.columns else [*rows.columns, "building_id"]
        own = F.coalesce(col("building_id"), F.lit(here)) if named == rows.columns else F.lit(here)
        whole = rows.select([own.alias(name) if name == "building_id" else col(name) for name in named])
        replace_partitions(whole, f"{self._root.rstrip('/')}/{entity}", "building_id", [here])
        self._tables.pop(entity, None)

    def _one(self, building: Buildings) -> int:
        return building if isinstance(building, int) else catalog.one_building(self.table("buildings"), building)[0]

    # catalog

    def get_orgs(self, id: Ids = None) -> DataFrame:
        return catalog.organizations(self.table("organizations"), id)

    def get_buildings(self, id: Ids = None) -> DataFrame:
        return catalog.buildings(self.table("buildings"), id)

    def get_building_info(self, buildings: Buildings) -> DataFrame:
        return catalog.building_info(self.table("buildings"), buildings)

    def get_users(self, id: Ids = None, max_roles: int | None = None) -> DataFrame:
        return catalog.users(self.table("users"), self.table("roles"), id, max_roles)

    def get_deployments(self, org_id: Ids = None) -> DataFrame:
        return catalog.deployments(self.table("deployments"), org_id)

    def get_equip_types(self) -> DataFrame:
        return catalog.equipment_types(self.table("equipment_types"))

    def get_point_types(self) -> DataFrame:
        return catalog.point_types(self.table("point_types"), self.table("measurements"))

    def get_tags(self) -> DataFrame:
        return catalog.listing(self.table("tags"))

    def get_all_units(self) -> DataFrame:
        return catalog.listing(self.table("units"))

    def get_all_measurements(self) -> DataFrame:
        return catalog.listing(self.table("measurements"))

    # points, equipment, metadata

    def select_points(self, query: selection.PointSelector | Mapping) -> selection.Selection:
        return selection.select_points(
            query, self.table("points"), self.table("equipment"), self.table("buildings")
        )

    def get_points_by_ids(self, id: Iterable | DataFrame | int) -> DataFrame:
        return selection.points_by_ids(self.table("points"), id)

    def get_equipment_by_ids(self, id: Iterable | DataFrame | int) -> DataFrame:
        return selection.equipment_by_ids(self.table("equipment"), id)

    def get_metadata(
        self,
        *,
        buildings: Buildings | None = None,
        selection: selection.Selection | Mapping | None = None,
    ) -> DataFrame:
        if (buildings is None) == (selection is None):
            raise ValueError("give either buildings or a selection")
        equipment, points = flatten(self.table("equipment")), flatten(self.table("points"))
        if selection is not None:
            return metadata.metadata_by_selection(selection, equipment, points)
        return metadata.metadata_by_building(buildings, self.table("buildings"), equipment, points)

    def keep_bucketed(self, root: str, buckets: int) -> bucketed.BucketedTables:
        """Points and equipment written in buckets, so that :meth:`get_metadata_bucketed` shuffles nothing."""
        return bucketed.keep_bucketed(flatten(self.table("equipment")), flatten(self.table("points")), root, buckets)

    def get_metadata_bucketed(self, kept: bucketed.BucketedTables, buildings: Buildings | None = None) -> DataFrame:
        ids = None if buildings is None else catalog.building_ids(self.table("buildings"), buildings)
        return bucketed.metadata_bucketed(kept, ids)

    # readings

    def _factors(self, units: Mapping[str, str] | DataFrame | None) -> DataFrame | None:
        if units is None:
            return None
        return timeseries.unit_factors(units, self.table("points"), self.table("unit_conversions"))

    def get_timeseries_raw(
        self,
        start_time: Moment,
        end_time: Moment,
        point_ids: Iterable | DataFrame | int,
        units: Mapping[str, str] | DataFrame | None = None,
        date_column: str | None = None,
    ) -> DataFrame:
        """``date_column`` names the partition column of readings, if there is one; then whole days are pruned."""
        return timeseries.timeseries_raw(
            self.table("readings"), start_time, end_time, point_ids, self._factors(units), date_column
        )

    def get_timeseries(
        self,
        start_time: Moment,
        end_time: Moment,
        point_ids: Iterable | DataFrame | int,
        units: Mapping[str, str] | DataFrame | None = None,
        unit_type: str = "default",
        **wide,
    ) -> DataFrame:
        # a statement about the default order only
        if self._unique_readings and "order_by" not in wide:
            wide.setdefault("unique_order", True)
        return timeseries.timeseries(
            self.table("readings"), start_time, end_time, point_ids, self._factors(units), unit_type, **wide
        )

    def get_timeseries_lists(
        self,
        start_time: Moment,
        end_time: Moment,
        point_ids: Iterable | DataFrame | int,
        units: Mapping[str, str] | DataFrame | None = None,
        unit_type: str = "default",
        date_column: str | None = None,
        **lists,
    ) -> DataFrame:
        """All readings of every second and name, in lists of bounded length; see :func:`timeseries.timeseries_lists`."""
        raw = self.get_timeseries_raw(start_time, end_time, point_ids, units, date_column)
        return timeseries.timeseries_lists(raw, unit_type, **lists)

    # staging

    def get_staging_equip(self, building_id: int) -> DataFrame:
        return staging.staged_in(self.table("staging_equipment"), building_id)

    def get_staging_devices(self, building_id: int) -> DataFrame:
        return staging.staged_in(self.table("staging_devices"), building_id)

    def get_staging_points(self, building_id: int) -> DataFrame:
        return staging.staged_in(self.table("staging_points"), building_id)

    def get_staging_data(self, building: Buildings, multi_equip: str = "text") -> DataFrame:
        return staging.staging_data(
            building,
            self.table("buildings"),
            flatten(self.table("staging_points")),
            flatten(self.table("staging_equipment")),
            flatten(self.table("staging_devices")),
            multi_equip,
        )

    def staged_rows(self, building: Buildings) -> DataFrame:
        """The staging view with ``p.equip_ids`` under the name uploads use."""
        return self.get_staging_data(building).withColumnRenamed("p.equip_ids", "e.equip_id")

    def upload_staging(self, building: Buildings, data_to_upload: DataFrame) -> staging.UploadResult:
        return staging.upload(self.staged_rows(building), data_to_upload)

    def upload_staging_csv(self, building: Buildings, path: str, schema: StructType | str) -> staging.UploadResult:
        """CSV files with a header row in place of a table; records that do not parse come back as errors."""
        read = read_upload_csv(self.table("staging_points").sparkSession, path, schema).kept()
        return staging.upload(self.staged_rows(building), read.rows, read.refused)

    def get_upload_changes(self, building: Buildings, data_to_upload: DataFrame) -> DataFrame:
        """What an upload of rows with topics would insert, change or leave as it is: (p.topic, change)."""
        return staging.upload_changes(self.staged_rows(building), data_to_upload)

    def promote_data(
        self, building: Buildings, live: DataFrame, data_to_promote: DataFrame | None = None
    ) -> staging.PromotionResult:
        """``live`` is a table keyed by ``p.topic``, such as one made from :meth:`get_metadata`."""
        return staging.promote(self.staged_rows(building), live, data_to_promote)

    def unpromote_data(
        self, building: Buildings, data_to_unpromote: DataFrame, unpromote_type: str = "points"
    ) -> staging.LiveTables:
        """The building's live points, equipment and relationships without what is listed."""
        here = catalog.one_building(self.table("buildings"), building)
        points = filter_by_ids(self.table("points"), "building_id", here)
        equipment = filter_by_ids(self.table("equipment"), "building_id", here)
        pairs = self.relationships(points)
        return staging.unpromote(points, equipment, data_to_unpromote, unpromote_type, pairs)

    def relationships(self, points: DataFrame | None = None) -> DataFrame:
        """(equipment_id, point_id) pairs of the live points, or of some of them."""
        live = self.table("points") if points is None else points
        return live.select(F.col("equip_id").alias("equipment_id"), F.col("id").alias("point_id"))
