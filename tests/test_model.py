import pytest
from pyspark.sql import functions as F

from docquery import EntityType, Model, Nav, Prop, Session
from docquery.operators import bulk
from docquery.operators.query import QueryError
from docquery.operators.unit_of_work import ConcurrencyError, TransactionError, UnitOfWork
from docquery.plans.model import Index, ModelError, camel_case


def model():
    return Model.of(
        EntityType("Animal", "animals", (Prop("id", "int", "_id"), Prop("name", "string", "fullName")), ("id",), (Nav("owner", "Owner", "owner_id", "id"),), seed=({"id": 1, "name": "Rex"},)),
        EntityType("Dog", base="Animal", props=(Prop("owner_id", "int"), Prop("good", "boolean")), seed=({"id": 2, "name": "Fido", "owner_id": 1, "good": True}, {"id": 3, "name": "Bello", "owner_id": None, "good": False})),
        EntityType("Owner", "owners", (Prop("id", "int", "_id"), Prop("name", "string"), Prop("age", "int", "age", to_store=lambda c: c.cast("string"), from_store=lambda c: c.cast("int"), stored_type="string"), Prop("version", "int", "_version", row_version=True)), ("id",),
                   (Nav("dogs", "Dog", "id", "owner_id", many=True),), seed=({"id": 1, "name": "Ann", "age": 40, "version": 1},)),
        EntityType("Line", "lines", (Prop("order", "int"), Prop("number", "int"), Prop("qty", "int")), ("order", "number"), query_filter=lambda r: r.qty > 0, seed=({"order": 1, "number": 1, "qty": 5}, {"order": 1, "number": 2, "qty": 0})),
    )


@pytest.fixture
def session(spark, tmp_path):
    s = Session(spark, f"file://{tmp_path}", model())
    assert s.ensure_created() and not s.ensure_created()
    return s


def test_names_and_stored_form(session):
    assert camel_case("OrderDetails") == "orderDetails" and camel_case("HTTPServer") == "httpServer"
    assert set(session.stored("Animal").columns) == {"_id", "fullName", "owner_id", "good", "_t"}
    assert session.stored("Line").schema["_id"].dataType.simpleString() == "struct<order:int,number:int>"
    assert session.stored("Owner").schema["age"].dataType.simpleString() == "string"


def test_hierarchy(session):
    assert session.set("Animal").count() == 3 and session.set("Dog").count() == 2
    assert session.set("Animal").of_type("Dog").where(lambda d: d.good).single().name == "Fido"
    animals = session.set("Animal")
    assert animals.where(animals.is_type("Dog")).count() == 2
    assert "good" not in session.set("Dog").cast("Animal").df.columns
    with pytest.raises(QueryError):
        session.set("Animal").cast("Dog")


def test_find_filters_and_converters(session):
    assert session.find("Line", 1, 1).qty == 5 and session.find("Line", 1, 2) is None, "the query filter holds"
    assert session.set("Line", ignore_filters=True).count() == 2
    assert session.set("Owner").where(lambda o: o.age > 39).single().name == "Ann" and session.set("Owner").sum("age") == 40
    with pytest.raises(QueryError):
        session.set("Line").find(1)


def test_navigations(session):
    assert [(r.name, r.o) for r in session.set("Dog").order_by("id").select("name", o=lambda d: d.owner.name).to_list()] == [("Fido", "Ann"), ("Bello", None)]
    owner = session.set("Owner").include("dogs").single()
    assert [d.name for d in owner.dogs] == ["Fido"]
    assert session.set("Owner").with_count("dogs").single().dogs_count == 1
    assert session.set("Dog").include("owner").where(lambda d: d.id == 3).single().owner is None


def test_model_is_checked():
    a = EntityType("A", "a", (Prop("id", "int"),), ("id",))
    bad = [
        [EntityType("A", "a", (Prop("id", "int"), Prop("id", "int")), ("id",))],
        [EntityType("A", "a", (Prop("id", "int"), Prop("x", "int", "_id")), ("id",))],
        [EntityType("A", "a", (Prop("id", "int"),), ("no",))],
        [a, EntityType("B", "other", base="A")],
        [EntityType("A", "a", (Prop("v", "int", row_version=True), Prop("w", "int", row_version=True)))],
        [EntityType("A", "a", (Prop("v", "string", row_version=True),))],
        [EntityType("A", "a", (Prop("m", "map<int,int>"),))],
        [EntityType("A", "a", (Prop("id", "int"),), ("id",), (Nav("x", "Nowhere", "id", "id"),))],
        [EntityType("A", "a", (Prop("v", "array<float>"),), indexes=(Index("i", ("v",), dimensions=2, similarity="odd"),))],
    ]
    for entities in bad:
        with pytest.raises(ModelError):
            Model.of(*entities)


def test_bulk(session):
    assert bulk.execute_update(session.set("Dog").where(lambda d: d.good), name=F.lit("Fidel")) == 1
    assert session.find("Dog", 2).name == "Fidel" and session.find("Animal", 1).name == "Rex"
    assert bulk.execute_update(session.set("Owner"), name=lambda o: F.upper(o.name)) == 1
    assert (session.find("Owner", 1).name, session.find("Owner", 1).version) == ("ANN", 2)
    assert bulk.execute_delete(session.set("Dog").order_by_descending("id").take(1)) == 1
    assert [r.id for r in session.set("Animal").order_by("id").to_list()] == [1, 2]
    assert bulk.execute_delete(session.set("Dog")) == 1 and session.set("Animal").count() == 1
    with pytest.raises(QueryError):
        bulk.execute_update(session.set("Owner"), age=lambda o: o.age + 1)
    with pytest.raises(QueryError):
        bulk.execute_update(session.set("Owner"))
    with pytest.raises(QueryError):
        bulk.execute_delete(session.set("Owner").select("id"))


def test_unit_of_work(session):
    u = UnitOfWork(session)
    u.add("Owner", id=2, name="Bob", age=30)
    u.update("Owner", 1, original={"version": 1}, name="Anna")
    u.add("Line", order=2, number=1, qty=1)
    assert u.save_changes() == 3
    assert (session.find("Owner", 1).name, session.find("Owner", 1).version, session.find("Owner", 2).version) == ("Anna", 2, 1)
    assert session.find("Line", 2, 1).qty == 1 and session.set("Line", ignore_filters=True).count() == 3
    u.update("Owner", 1, original={"version": 1}, name="late")
    with pytest.raises(ConcurrencyError):
        u.save_changes()
    assert session.find("Owner", 1).name == "Anna"
    w = UnitOfWork(session)
    w.add("Owner", id=2, name="again", age=1)
    with pytest.raises(ConcurrencyError):
        w.save_changes()
    w = UnitOfWork(session)
    w.remove("Owner", 2)
    assert w.save_changes() == 1 and session.find("Owner", 2) is None


def test_repeated_changes_of_one_entity(session):
    u = UnitOfWork(session)
    u.update("Owner", 1, original={"version": 1}, name="X")
    u.update("Owner", 1, age=9)
    assert u.save_changes() == 1
    assert [(r.id, r.name, r.age, r.version) for r in session.set("Owner").to_list()] == [(1, "X", 9, 2)]
    u.update("Owner", 1, name="gone")
    u.remove("Owner", 1)
    u.add("Owner", id=1, name="new", age=1)
    u.update("Owner", 1, name="newer")
    u.add("Owner", id=3, name="c", age=3)
    u.remove("Owner", 3)
    assert u.save_changes() == 2
    assert [(r.id, r.name, r.age) for r in session.set("Owner").to_list()] == [(1, "newer", 1)]
    assert session.reload("Owner", 1).name == "newer" and session.reload("Owner", 3) is None


def test_conflicts_of_added_keys(session):
    """A key that is added again excuses no other."""
    session_rows = session.set("Line", ignore_filters=True)
    u = UnitOfWork(session)
    u.remove("Line", (1, 1))
    u.add("Line", order=1, number=1, qty=7)
    u.add("Line", order=1, number=2, qty=8)
    with pytest.raises(ConcurrencyError):
        u.save_changes()
    assert session_rows.count() == 2
    for bad in (lambda w: (w.remove("Line", (1, 1)), w.update("Line", (1, 1), qty=1)), lambda w: (w.add("Line", order=9, number=9, qty=1), w.add("Line", order=9, number=9, qty=2))):
        w = UnitOfWork(session)
        bad(w)
        with pytest.raises(ConcurrencyError):
            w.save_changes()


def test_composite_key_stands_for_the_entity(session):
    u = UnitOfWork(session)
    u.add("Line", order=1, number=0, qty=1)
    u.save_changes()
    lines = session.set("Line", ignore_filters=True)
    assert [(r.order, r.number) for r in lines.order_by_descending(lambda x: x).to_list()] == [(1, 2), (1, 1), (1, 0)]


def test_transactions(session):
    u = UnitOfWork(session)
    u.begin()
    u.update("Owner", 1, name="x")
    u.save_changes()
    assert session.find("Owner", 1).name == "Ann", "not before the commit"
    u.update("Owner", 1, age=41)
    u.save_changes()
    u.rollback()
    assert session.find("Owner", 1).name == "Ann"
    u.begin()
    u.update("Owner", 1, name="y")
    u.save_changes()
    with pytest.raises(TransactionError):
        u.execute_delete(session.set("Owner"))
    u.commit()
    assert session.find("Owner", 1).name == "y"
    with pytest.raises(TransactionError):
        u.commit()


def test_created_and_deleted(session):
    assert session.can_connect() and session.exists("Owner")
    assert session.ensure_deleted() and not session.exists("Owner")
