"""Each vendor's mapping on a small export: every table builds, keeps the right rows and meets its contract."""

import pytest

from rosterlift import RunContext
from rosterlift.quality import CONTRACTS, evaluate, matching_contract
from rosterlift.sources import TableReader
from rosterlift.vendors import VENDORS
from rosterlift.vendors import migrate as migrated
from rosterlift.vendors.bullhorn import AttributeSource

AT = "2024-01-02 03:04:05"
# Columns that the vendor's own models do not have either.
LACKING = {("loxo", "project_company_contacts"): {"company_contact_id"}, ("recruit_crm", "custom_attributes"): {"id"}}
# Tables that a contract's pattern matches by name only.
OTHERS = {"people_overview"}


def migrate(vendor, *args, **options):
    """A vendor's tables, all held against the columns that their contracts require."""
    got = migrated(vendor, *args, **options)
    for name, table in got.items():
        rules = CONTRACTS.get(matching_contract(f"{name}_x") or "", {}) if name not in OTHERS else {}
        missing = {*rules.get("required", []), *rules.get("not_null", [])} - {*table.columns}
        assert missing == LACKING.get((vendor, name), set()), (vendor, name)
    return got


@pytest.fixture
def export(spark):
    """``export({name: (schema, rows)})`` gives a reader of those tables."""
    def build(tables):
        frames = {name: spark.createDataFrame(rows, schema).coalesce(1) for name, (schema, rows) in tables.items()}
        return lambda name: frames[name]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield build
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


BULLHORN = {
    "bh_usercontact": (
        "userid long, firstname string, lastname string, email string, email2 string, phone string, phone2 string, mobile string, workphone string, customint1 int, customtext2 string, customtext3 string, "
        "clientcorporationid long, address1 string, address2 string, city string, state string, zip string, countryid int, occupation string, linkeduserid long, isdeleted int, dateadded string, "
        "datelastmodified string, degreelist string",
        [(1, "Ann", "Lee", "Ann@Gmail.com", None, "+44 20", None, "0044 7", None, 2, "https://www.linkedin.com/in/ann/", None, None, "1 High St.", "", "Rome", None, "10-1", 2268, "CEO", None, 0, AT, AT, None),
         (2, "Bob", "Ray", "bob@firm.com", None, None, None, None, "020 7946", None, None, None, 10, None, None, None, None, None, None, None, 1, 0, AT, AT, None),
         (3, "Default Contact", "X", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, 0, AT, AT, None),
         (4, "Sue", "Staff", "sue-corp.example.com", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, 0, AT, AT, None),
         (7, "Kim", "Staff", "KIM@corp.example.com", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, 0, AT, AT, None),
         (5, "Gone", "Away", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, 1, AT, AT, None),
         (6, "Idle", "Man", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, None, 0, AT, AT, None)]),
    "bh_usercomment": ("usercommentid long, userid long, commentinguserid long, comments string, action string, dateadded string",
                       [(1, 1, 4, "<p>Hello</p>", "Note", AT), (2, 2, 9, "Met", "Interview", AT), (3, 1, 4, "spam", "Mail Merge", AT), (4, 3, 4, "x", "Note", AT), (5, 5, 4, "x", "Note", AT)]),
    "bh_client": ("clientid long, userid long, clientcorporationid long, status string, isdeleted int, dateadded string", [(70, 2, 10, "Active", 0, AT), (71, 2, 11, "odd", 0, "2020-01-01 00:00:00")]),
    "bh_clientcorporation": (
        "clientcorporationid long, name string, companydescription string, status string, customtext1 string, address1 string, address2 string, city string, state string, zip string, countryid int, numemployees int, "
        "dateadded string, datelastmodified string, phone string, companyurl string, linkedinprofilename string, notes string",
        [(10, "Acme", "<b>Big</b>", " Terms Signed", "NO", "5 Road", None, "Rome", None, "1", 1, 60, AT, AT, "0207 946", "https://www.Acme.com/", None, "<i>vip</i>"),
         (11, "Idle Ltd", None, "Archive", "no", None, None, None, None, None, None, 0, AT, AT, None, None, None, None), (12, "Imported Contacts", None, None, None, None, None, None, None, None, None, None, AT, AT, None, None, None, None)]),
    "bh_userworkhistory": ("userworkhistoryid long, userid long, companyname string, title string, startdate string, enddate string, comments string",
                           [(1, 1, " ACME ", "Dev", "2020-01-01 00:00", None, "<b>x</b>"), (2, 2, "Else", "Ops", "2019-01-01", "2020-01-01", ""), (3, 1, "", "Dev", "2020-01-01", None, None)]),
    "bh_usereducation": ("usereducationid long, userid long, school string, degree string, major string, gpa string, startdate string, enddate string", [(1, 2, "MIT", "BSc", "Maths", "4", "2000-09-01", None)]),
    "bh_jobopportunity": (
        "jobpostingid long, linkedjobpostingid long, userid long, clientcorporationid long, clientuserid long, title string, employmenttype string, publicdescription string, description string, status string, salary double, "
        "dateadded string, dateclosed string, isdeleted int, address string, address2 string, city string, state string, zip string",
        [(100, None, 4, 10, 2, "CTO", "Contract", "<p>job</p>", None, "Placed", 1.0, AT, None, 0, "5 Road", None, "Rome", None, "10001"),
         (101, 102, 9, 10, 2, "CFO", "Retained", None, None, "Open", 1.0, AT, None, 0, None, None, None, None, None),
         (102, None, 4, 10, 2, "copy", None, None, None, "Open", 1.0, AT, None, 0, None, None, None, None, None), (103, None, 4, 10, 2, "gone", None, None, None, "Open", 1.0, AT, None, 1, None, None, None, None, None)]),
    "bh_jobresponse": ("jobresponseid long, jobpostingid long, userid long, sendinguserid long, status string, dateadded string",
                       [(1, 100, 1, 4, " Placed", AT), (2, 100, 1, 4, "Rejected", "2020-01-01 00:00:00"), (3, 101, 1, 9, "Offer Rejected", AT), (4, 103, 1, 4, "Placed", AT)]),
    "bh_jobresponsehistory": ("jobresponseid long, status string, dateadded string", [(1, "placed", "2024-02-03 00:00:00"), (1, "placed", AT)]),
    "bh_placement": ("placementid long, userid long, jobpostingid long, salary double, fee double, comments string, dateadded string", [(500, 1, 100, 1000.0, 0.25, " ", AT), (501, 1, 100, 0.0, 0.2, None, AT)]),
    "bh_commission": ("commissionid long, placementid long, userid long, commissionpercentage double", [(900, 500, 7, 0.5), (901, 500, 1, 0.5)]),
    "bh_userwork": ("userworkid long, userid long, name string, type string", [(1, 1, "Ann.pdf", "CV"), (2, 1, "pic", "Photo")]),
    "bh_userworkfile": ("userworkfileid long, userworkid long, directory string, fileextension string, dateadded string", [(7, 1, "a\\b\\", ".pdf", AT), (8, 2, "a", ".png", AT)]),
}


def test_bullhorn(export, ctx, tmp_path):
    ctx = RunContext(ctx.client, ctx.agency_id, ctx.master_id, ctx.domain, ctx.run_ts, {"notes": ["note"], "meetings": ["interview"]})
    got = migrate("bullhorn", export(BULLHORN), ctx, str(tmp_path))
    assert {(r.id, r.email) for r in got["users"].collect()} == {(4, "sue@corp.example.com"), (7, "kim@corp.example.com")}
    assert ids(got["people"]) == [1]  # 2 is a duplicate of 1, 3 a placeholder, 4 staff, 5 deleted, 6 without activity
    assert {(r.id, r.restriction_type, r.relationship) for r in got["companies"].collect()} == {(10, "hard", "client"), (11, "none", "none")}
    person = {(r.type, r.value): (r.person_id, r.identity_type_type) for r in got["person_identities"].collect()}
    assert person == {("email", "ann@gmail.com"): (1, "personal"), ("email", "bob@firm.com"): (1, "corporate"), ("phone", "+4420"): (1, "personal"), ("phone", "+447"): (1, "personal"),
                      ("phone", "0207946"): (1, "corporate"), ("linkedin", "linkedin.com/in/ann"): (1, None)}
    assert [(r.id, r.person_id, r.relationship) for r in got["company_contacts"].collect()] == [(70, 1, "client")]
    assert [(r.id, r.text.strip()) for r in got["person_notes"].collect()] == [(1, "Hello")]
    assert [(r.id, r.person_id, r.created_by_atlas_id) for r in got["meetings"].collect()] == [(2, 1, "master-0")]
    work = {r.id: r for r in got["experiences"].collect()}
    assert work[1].company_id == 10 and work[2].person_id == 1 and work[2].description is None and len(work) == 2
    assert ids(got["educations"], "person_id") == [1]
    assert {(r.id, r.state, r.close_reason, r.contract_type) for r in got["projects"].collect()} == {(100, "closed", "won", "contract"), (101, "on_hold", None, "full_time")}
    people = {r.id: r for r in got["candidates"].collect()}
    assert set(people) == {1, 3} and people[1].hired_at == "2024-02-03T00:00:00" and people[1].status == "Hired"
    assert (people[3].rejection_type, people[3].rejection_reason, people[3].atlas_rejected_by_id) == ("self", "accepted_another_offer", "master-0")
    assert [(r.amount, r.notes) for r in got["project_fees"].collect()] == [(250, "Migrated Placement Fee")]
    assert [(r.candidate_id, r.project_id) for r in got["placements"].collect()] == [(1, 100)]
    assert [(r.id, str(r.share)) for r in got["project_fee_splits"].collect()] == [(900, "50.00")]
    assert [(r.file_name, r.type) for r in got["file_person_mapping"].collect()] == [("people/a/b/7.pdf", "resume")]
    assert ids(got["project_company_contacts"], "project_id") == []  # the contact is the duplicate, not the survivor
    assert ids(got["company_notes"]) == [10]
    for name in ("people", "companies", "company_contacts", "projects", "candidates", "meetings", "person_notes", "experiences", "educations"):
        failed = evaluate(got[name], f"{name}_bh").where("severity = 'fail' AND NOT passed AND rule NOT IN ('uuid_columns', 'required')").collect()
        assert [(r.rule, r.column_name) for r in failed] == [], name


EZEKIA = {
    "users": ("id int, fullname string, email string, role string", [(1, "Sue", "SUE@corp.example.com", "search"), (2, "Al", "al@other.com", "search"), (3, "No", "no@corp.example.com", "admin")]),
    "people": ("id int, firstname string, lastname string, created_at string, updated_at string", [(1, "Ann", "Lee", AT, AT), (2, "Bob", "Ray", AT, None)]),
    "people_positions": (
        "id int, person_id int, company_id int, location_id int, primary boolean, company string, title string, start_date string, end_date string, summary string, created_at string, updated_at string",
        [(1, 1, 10, None, True, None, "CEO", "2020-01-01", "9999-12-31", "s", AT, AT), (2, 1, 10, 5, False, "Acme", "CTO", "2019-01-01", "2020-01-01", None, AT, AT), (3, 2, None, None, False, "Else", " ", None, None, None, AT, AT)]),
    "locations": ("id int, location_name string", [(5, "Rome")]),
    "search_firms_clients": ("client_id int, name string, description string, size string, label string, speciality string, user_id int, created_at string, updated_at string",
                             [(10, "Acme", "d", "51-200 employees", "client", "<b>steel</b>", 1, AT, AT), (11, "Idle", None, None, None, " ", None, AT, AT)]),
    "emails": ("id int, address string, type string, is_default int, emailable_type string, emailable_id int, created_at string, updated_at string",
               [(1, "A@x.com", "work", 1, "person", 1, AT, AT), (2, "a@x.com ", "home", 0, "person", 2, "2025-01-01", AT), (3, "c@x.com", "work", 0, "client", 10, AT, AT)]),
    "phones": ("id int, number string, number_searchable string, type string, is_default int, phoneable_type string, phoneable_id int, created_at string, updated_at string", [(1, "+44 1", "+441", "home", None, "person", 2, AT, AT)]),
    "links": ("id int, url string, type string, linkable_type string, linkable_id int, created_at string, updated_at string",
              [(1, "https://www.linkedin.com/in/a/", "linkedin", "person", 1, AT, AT), (2, "http://acme.com/", "website", "client", 10, AT, AT), (3, "x.com/y", "twitter", "person", 1, AT, AT)]),
    "people_educations": ("id int, person_id int, start int, `end` int, degree string, field string, school string, education_searchable string, summary string, created_at string, updated_at string",
                          [(1, 1, 1999, 0, "BSc", "Maths", "MIT", None, "s", AT, AT), (2, 1, 0, 0, None, None, " ", None, None, AT, AT)]),
    "search_firms_briefs": ("brief_id int, client_id int, user_id int, title string, description string, label string, end_date string, deleted_at string, created_at string, updated_at string",
                            [(100, 10, 1, "CTO", "d", None, "2024-03-01", None, AT, AT), (101, 99, None, "CFO", None, None, None, None, AT, AT), (102, 10, 1, "gone", None, None, None, AT, AT, AT)]),
    "briefs_compensation_ranges": ("brief_id int, min int, max int, currency string", [(100, 5, 9, "GBP"), (101, None, 7, "EUR")]),
    "briefs_candidates": ("id int, brief_id int, person_id int, added_by string, created_at string, updated_at string", [(1, 100, 1, "Sue S", AT, AT), (2, 101, 2, " ", AT, AT)]),
    "statusables": ("id int, statusable_id int, constraint_id int, status_tag_id int, statusable_type string, constraint_type string, created_at string, updated_at string",
                    [(1, 1, 100, 1, "person", "assignment", "2024-01-01", None), (2, 1, 100, 2, "person", "assignment", "2024-02-01", None), (3, 1, 100, 1, "client", "assignment", "2024-03-01", None)]),
    "search_firms_status_tags": ("id int, tag_text string, tag_type string", [(1, "Offered", "candidate"), (2, "Client Rejected", "candidate"), (3, "Old", "client")]),
    "notes": ("id int, is_automated int, notable_type string, notable_id int, text string, user_id int, created_at string, updated_at string",
              [(1, 0, "person", 1, "<p>hi</p>", 1, AT, AT), (2, 1, "person", 1, "auto", 1, AT, AT), (3, 0, "person", 1, "Added to SourceWhale", 1, AT, AT)]),
    "outlook_emails": ("id int, user_id int, `from` string, `to` string, subject string, text string, raw_html string, created_at string, updated_at string", [(9, 1, "a", "b", "Hi", None, "<p>x</p>", AT, AT)]),
    "outlook_emailables": ("person_id int, outlook_email_id int", [(2, 9)]),
    "meetings": ("id int, user_id int, channel_type string, channel_id int, title string, details string, agenda string, note string, start_date string, start_date_utc string, end_date string, end_date_utc string, created_at string, updated_at string",
                 [(1, 1, "Person", 2, "t", None, "<i>a</i>", None, AT, None, AT, None, AT, AT), (2, 9, "brief", 100, "t", "d", None, None, AT, None, "2030-01-01", None, AT, AT), (3, 1, "brief", 555, "t", "d", None, None, AT, None, None, None, AT, AT)]),
    "people_aspirations": ("id int, person_id int, summary string, base int, bonus int, created_at string, updated_at string", [(1, 1, "n", None, None, AT, None)]),
    "aspirations_permanent": ("id int, aspiration_id int, base int, bonus int, currency string", [(1, 1, 1000, 10, "usd")]),
}


def test_ezekia(spark, export, ctx, tmp_path):
    prior = spark.createDataFrame([("known-1", "Sue S", "sue@corp.example.com", "active")], "id string, name string, email string, status string")
    got = migrate("ezekia", export(EZEKIA), ctx, str(tmp_path), prior_users=prior, fallback_company="none")
    assert [tuple(r) for r in got["users"].collect()] == [("1", "known-1", "Sue S", "sue@corp.example.com", "active")]
    assert {r.id: r.location_locality for r in got["people"].collect()} == {1: "Rome", 2: None}
    assert {r.id: (r.company_size, r.relationship) for r in got["companies"].collect()} == {10: ("51-200", "client"), 11: (None, "none")}
    assert {(r.id, r.person_id, r.value, r.identity_type_type) for r in got["person_identities"].collect()} == {
        ("1_email", 1, "a@x.com", "corporate"), ("1_phone", 2, "+441", "personal"), ("1_linkedin", 1, "linkedin.com/in/a", "personal")}
    assert [(r.value, r.is_primary) for r in got["company_identities"].collect()] == [("acme.com", True)]
    assert [(r.person_id, r.title, r.relationship) for r in got["company_contacts"].collect()] == [(1, "CEO", "client")]
    assert [(r.id, r.text, r.created_by_atlas_id) for r in got["company_notes"].collect()] == [("10_note", "steel", "known-1")]
    assert {(r.id, r.company_name, r.finished_at) for r in got["experiences"].collect()} == {(1, "Acme", None), (2, "Acme", "2020-01-01")}
    assert [(r.started_at, r.finished_at, r.description) for r in got["educations"].collect()] == [("1999-01-01", None, "s")]
    assert {(r.id, r.salary, r.close_reason, r.atlas_owner_id) for r in got["projects"].collect()} == {(100, "5 - 9", "won", "known-1"), (101, "7", "cancelled", "master-0")}
    people = {r.id: (r.status, r.rejection_type, r.rejected_at, r.atlas_owner_id) for r in got["candidates"].collect()}
    assert people == {1: ("Offer", "by_client", "2024-02-01T00:00:00", "known-1"), 2: ("Added", None, None, "known-1")}
    assert {(r.id, r.text) for r in got["person_notes"].collect()} == {("1", "hi"), ("9", "From: a | To: b — Hi x")}
    assert {(r.id, r.person_id, r.status) for r in got["meetings"].collect()} == {(1, 2, "completed"), (2, 1, "planned")}
    assert [(r.basic_salary, r.bonus_salary, r.total_salary, r.currency) for r in got["person_salaries"].collect()] == [(1000, 100, 1100, "USD")]


_LIST = "slug string, first_name string, last_name string, email string, contact_number string, profile_linkedin string, city string, state string, created_on string, updated_on string, created_by long"
EPOCH = "1700000000"
RECRUIT_CRM = {
    "candidate_data": (_LIST + ", fulladdress string, country string, profile_github string, owner_id long",
                       [("a1", "Ann", "Lee", "Ann@x.com", "+44 1", None, "Rome", "RM", EPOCH, EPOCH, 7, "", "Italy", "https://github.com/Ann/", 7), ("a2", "Al", "Po", None, None, None, "Bari", "BA", EPOCH, EPOCH, 8, "Via 1", "Italy", None, 9)]),
    "contact_data": (_LIST + ", full_address string, mobile_number string, company_slug string, designation string",
                     [("c1", "Ann", "L", " ann@x.com", None, "linkedin.com/in/ann", "Rome", "RM", EPOCH, EPOCH, 7, "Via 2", "0044 9", "f1", None), ("c2", "Cy", "Zed", "cy@f.com", None, None, "Pisa", "PI", EPOCH, EPOCH, 8, None, None, "f9", "CEO")]),
    "company_data": ("slug string, company string, full_address string, city string, company_state string, country string, company_size string, website string, profile_linkedin string, created_on string, updated_on string",
                     [("f1", "Acme", " ", "Rome", "RM", "Italy", "60", "https://www.Acme.com/", None, EPOCH, EPOCH), ("f2", "Idle", None, None, None, None, "x", "acme.com", "linkedin.com/company/i/", "1800000000", EPOCH)]),
    "job_data": ("slug string, name string, job_status string, owner_id long, created_by long, updated_by long, company_slug string, contact_slug string, job_code string, created_on string, updated_on string",
                 [("j1", "CTO", "Filled", 7, 7, 8, "f1", "c1", "J-1", EPOCH, EPOCH), ("j2", "CFO", "Lead/ Prospect", 9, 9, 9, "f9", "c9", "J-2", EPOCH, EPOCH), ("j3", "COO", "Open", 7, 7, 7, None, None, "J-3", EPOCH, EPOCH)]),
    "job_description_data": ("job_slug string, job_description string", [("j1", "<p>Lead</p>")]),
    "note_data": ("note_id long, related_to string, note string, note_type_id int, created_by long, updated_by long, created_on string, updated_on string",
                  [(1, "j1", "<b>late</b>", 1, 7, 7, EPOCH, EPOCH), (2, "a2", "call", 58736, 7, 9, EPOCH, EPOCH), (3, "f1", "firm", 2, 9, 7, EPOCH, EPOCH), (4, "c1", "met", 1, 7, 7, EPOCH, EPOCH)]),
    "call_log_data": ("related_candidate string, related_contact string, call_notes string, created_by long, updated_by long, created_on string, updated_on string", [(None, "c2", "rang", 7, 7, EPOCH, EPOCH), (None, None, "lost", 7, 7, EPOCH, EPOCH)]),
    "assignment_data": ("candidate_slug string, job_slug string, candidate_status string, stage_date string, created_on string, updated_on string", [("a1", "j1", "Placed", "1700100000", EPOCH, EPOCH), ("a2", "j1", "CV Sent", EPOCH, EPOCH, EPOCH)]),
    "hotlist_data": ("hotlist_id long, name string, entity_name string", [(1, "VIP", "candidates"), (2, "Best", "candidates"), (3, "Key", "companies"), (4, "Warm", "contacts")]),
    "candidate_hotlist_data": ("candidate_slug string, hotlist_id long", [("a1", 1), ("a1", 9)]),
    "contact_hotlist_data": ("contact_slug string, hotlist_id long", [("c1", 4), ("c2", 4)]),
    "company_hotlist_data": ("company_slug string, hotlist_id long", [("f1", 3)]),
}


def test_recruit_crm(spark, export, ctx, tmp_path):
    users = spark.createDataFrame([("s@x.com", "Sue", 7, "u-7")], "email string, name string, id long, atlas_id string")
    work = spark.createDataFrame([("a1", "2020-01-01", None, "Dev", None, " acme", "work_history_1_data"), ("a1", "2020-01-01", None, "Dev", None, "acme", "work_history_2_data"),
                                  ("a2", None, None, "Ops", None, "Else", "x")],
                                 "candidate_slug string, work_start_date string, work_end_date string, title string, description string, work_company_name string, source_table string")
    study = spark.createDataFrame([("a2", "MIT", "BSc", "Maths", None, "2000-01-01", None)],
                                  "candidate_slug string, institute_name string, educational_qualification string, educational_specialization string, education_description string, education_start_date string, education_end_date string")
    got = migrate("recruit_crm", export(RECRUIT_CRM), ctx, str(tmp_path), users=users, work_history=work, education_history=study, leads_lost_before="2025-03-01T00:00:00")
    assert {(r.id, r.contact_id, r.location_locality) for r in got["people"].collect()} == {("a1", "c1", "Rome Italy"), ("a2", None, "Via 1"), ("ccc2", "c2", "Pisa PI")}
    assert {(r.person_id, r.type, r.value, r.identity_type_type) for r in got["person_identities"].collect()} == {
        ("a1", "email", "ann@x.com", "personal"), ("a1", "phone", "+441", "personal"), ("a1", "github", "github.com/ann", "personal"), ("a1", "linkedin", "linkedin.com/in/ann", "personal"),
        ("a1", "phone", "+449", "corporate"), ("ccc2", "email", "cy@f.com", "corporate")}
    assert {(r.id, r.location_locality, r.size) for r in got["companies"].collect()} == {("f1", "Rome", "51-200"), ("f2", None, None)}
    assert {(r.company_id, r.type, r.value) for r in got["company_identities"].collect()} == {("f1", "website", "acme.com"), ("f2", "linkedin", "linkedin.com/company/i")}
    assert [(r.id, r.title, r.company_id) for r in got["company_contacts"].collect()] == [("c1", "contact", "f1")]
    assert [(r.company_id, r.company_name, r.started_at) for r in got["experiences"].collect()] == [("f1", "Acme", "2020-01-01")]
    assert ids(got["educations"], "person_id") == ["a2"]
    assert {(r.id, r.state, r.close_reason, r.closed_at, r.notes, r.atlas_owner_id) for r in got["projects"].collect()} == {
        ("j1", "closed", "won", "2023-11-16T00:00:00", "late", "u-7"), ("j2", "closed", "lead_lost", "2023-11-14T00:00:00", None, "master-0"), ("j3", "active", None, None, None, "u-7")}
    assert [(r.project_id, r.company_contact_id) for r in got["project_company_contacts"].collect()] == [("j1", "c1")]
    assert {(r.person_id, r.status, r.atlas_owner_id) for r in got["candidates"].collect()} == {("a1", "Hired", "u-7"), ("a2", "Presented", "master-0")}
    assert {(r.person_id, r.type, r.text) for r in got["person_notes"].collect()} == {("a2", "phone_call", "call"), ("c2", "phone_call", "rang"), ("c1", "manual", "met")}
    assert [(r.id, r.company_id, r.created_by_atlas_id) for r in got["company_notes"].collect()] == [(3, "f1", "master-0")]
    assert {(r.value, r.position) for r in got["custom_attribute_options"].collect()} == {("Best", 1), ("VIP", 2), ("Key", 1), ("Warm", 1)}
    assert ids(got["person_custom_attribute_values"], "person_id") == ["a1", "a1", "ccc2"]
    assert ids(got["company_custom_attribute_values"], "company_id") == ["f1"]
    for name in ("candidates", "custom_attribute_options", "company_custom_attribute_values"):
        failed = evaluate(got[name], f"{name}_rcrm").where("severity = 'fail' AND NOT passed AND rule <> 'uuid_columns'").collect()
        assert [(r.rule, r.column_name) for r in failed] == [], name


UK, ISO = "02/01/2024 03:04:05", "2024-01-02 03:04:05"
RECRUITLY = {
    "users": ("user_id string, first_name string, surname string, email string, is_disabled string, createdon string, modifiedon string",
              [("u1", "Sue", " ", "SUE@corp.example.com", "false", UK, ISO), ("u2", "Sue", "Old", "sue@corp.example.com", "true", "01/01/2020 00:00:00", ISO), ("u3", "X", "Y", "x@y.com", None, UK, UK)]),
    "candidates": (
        "candidate_id string, first_name string, surname string, internal_overview string, city string, region string, country string, postcode string, owner_id string, createdon string, modifiedon string, email string, "
        "alternate_email string, home_phone string, work_phone string, mobile string, linkedin string, preferences string, reasons_for_leaving string, internal_notes string, current_salary string, expected_pay string, status string, "
        "internal_cv_file_name string",
        [("a1", " Ann ", "Lee", " o ", "Rome", "", None, "1", "u1", UK, ISO, "a@gmail.com", "a@firm", None, "0044 20 1", "+44 7", "https://linkedin.com/in/a", "<b>remote</b>", " ", None, "45000", "50,000 - 60,000", "Placed", "Ann CV.pdf"),
         ("a2", "Al", "Po", None, None, None, None, None, "u9", ISO, UK, "A@gmail.com", None, None, None, "12", None, None, None, "x", "0.0", "NA", "Active", "pic.png")]),
    "contacts": ("contact_id string, first_name string, surname string, description string, address_line string, city string, region string, country string, postcode string, owner_id string, createdon string, modifiedon string, "
                 "email string, work_phone string, mobile string, company_id string, headline string",
                 [("c1", "Cy", "Zed", None, "Via 1", None, None, None, None, "u1", UK, ISO, "cy@firm.com", None, None, "f1", " "), ("c2", "No", "Co", None, None, None, None, None, None, None, UK, UK, None, None, None, None, "CEO")]),
    "companies": ("company_id string, company_name string, status string, company_type string, description string, address_line string, city string, region string, post_code string, country string, createdon string, modifiedon string, "
                  "land_phone string, website string, linkedin string, internal_notes string, benefits_package string, terms_agreed string",
                  [("f1", "Acme", None, "Prospect Co", "<b>x</b>", None, "Rome", None, None, None, UK, ISO, "020 1", "www.Acme.com", None, "<i>n</i>", None, "20%"), ("f2", " ", "live", None, None, None, None, None, None, None, UK, UK, None, None, None, None, None, None)]),
    "jobs": ("job_id string, title string, job_description string, short_description string, company_id string, owner_id string, contact_id string, createdon string, modifiedon string, job_type string, archived string, job_location string, "
             "job_reference_id string",
             [("j1", "CTO", "<b>y</b>", "this is a DUMMY job", "f1", "u1", "c1", "02/05/2024 00:00:00", ISO, "Contract role", "false", " ", "R1"), ("j2", "CFO", None, None, "f1", "u9", None, "01/12/2023 00:00:00", ISO, None, None, "Rome", "R2"),
              ("j3", "COO", None, None, "f9", "u1", "c1", UK, UK, None, None, None, "R3")]),
    "job_pipelines": ("pipeline_id string, job_id string, candidate_id string, createdby string, createdon string, modifiedon string, pipeline_status string, is_rejected string, reject_reason string",
                      [("p1", "j1", "a1", "u1", UK, ISO, "Interview", "false", None), ("p2", "j1", "a2", "u9", UK, ISO, "Offer", "True", "Withdrew"), ("p3", "j1", "a2", "u9", UK, "01/01/2020 00:00:00", "Applied", None, None)]),
    "tasks": ("task_id string, subject string, message string, linked_to_records string, createdon string, modifiedon string",
              [("t1", "Call ", "<p>now</p>", "COMPANY:f1 ", UK, UK), ("t2", "Call", " ", "COMPANY:f1", UK, UK), ("t3", "Invoice 1", "x", "COMPANY:f1", UK, UK), ("t4", "x", "y", "JOB:f1", UK, UK)]),
    "attachments": ("linked_to string, attachment_name string", [("a1", "profile.DOCX"), ("f1", "terms.pdf"), ("a1", "pic.png")]),
}


def test_recruitly(export, ctx, tmp_path):
    got = migrate("recruitly", export(RECRUITLY), ctx, str(tmp_path))
    assert [(r.id, r.name.strip(), r.created_at, r.status) for r in got["users"].collect()] == [("u1", "Sue", "2024-01-02T00:00:00Z", "active")]
    assert {(r.id, r.first_name, r.created_by_atlas_id == "master-0") for r in got["people"].collect()} == {("a1", "Ann", False), ("a2", "Al", True), ("c1", "Cy", False), ("c2", "No", True)}
    assert {(r.person_id, r.type, r.value, r.identity_type_type, r.favourite) for r in got["person_identities"].collect()} == {
        ("a1", "email", "a@gmail.com", "personal", True), ("a1", "phone", "+447", "personal", True), ("a1", "phone", "+44201", "corporate", False), ("a1", "linkedin", "linkedin.com/in/a", None, False),
        ("c1", "email", "cy@firm.com", "corporate", False)}
    assert [(r.id, r.relationship, r.summary) for r in got["companies"].collect()] == [("f1", "target", "**x**")]
    assert {(r.type, r.value) for r in got["company_identities"].collect()} == {("phone", "0201"), ("website", "acme.com")}
    assert [(r.id, r.relationship, r.title) for r in got["company_contacts"].collect()] == [("c1contactf1", "prospect", "Missing Title")]
    assert {(r.id, r.state, r.contract_type, r.notes) for r in got["projects"].collect()} == {("j1", "active", "contract", None), ("j2", "closed", "full_time", None)}
    assert [(r.project_id, r.company_contact_id) for r in got["project_company_contacts"].collect()] == [("j1", "c1contactf1")]
    assert {(r.id, r.status, r.rejection_type, r.rejection_reason, r.hired_at) for r in got["candidates"].collect()} == {
        ("p1", "Hired", None, None, "2024-01-02T03:04:05"), ("p2", "Offer", "self", "other", None)}
    assert {(r.id, r.text) for r in got["person_notes"].collect()} == {("rect_pref_a1", "Preferences:\r\nremote"), ("rect_internal_a2", "Internal notes:\r\nx")}
    assert {(r.id, r.text) for r in got["company_notes"].collect()} == {
        ("rect_internal_f1", "Internal notes:\r\nn"), ("rect_terms_f1", "Terms agreed:\r\n20%"), ("rect_task_t1", "Task: Call\r\nnow"), ("rect_task_t2", "Task: Call")}
    assert {(r.id, r.basic_salary, r.expected_salary_min, r.expected_salary_max) for r in got["person_salaries"].collect()} == {("Salary::a1", 45000, None, None), ("Salary_expected::a1", None, 50000, 60000)}
    assert {(r.person_id, r.file_name, r.type) for r in got["file_person_mapping"].collect()} == {("a1", "internalcvs/Ann CV.pdf", "resume"), ("a1", "attachments/profile.DOCX", "resume")}
    assert ids(got["company_map_files"], "company_id") == ["f1"]


VINCERE = {
    "public_user_account": ("id int, email string, name string, deleted_timestamp string", [(1, "sue@corp.example.com", "Sue S", None), (2, None, "No Mail", None), (3, "x@vincere.io", "Bot", None), (4, "old@x.y", "Old", AT), (5, "none", "Al Po", None)]),
    "public_candidate": ("id int, external_id string, email string, email2 string, work_email string, phone string, phone2 string, work_phone string, linked_in_profile string, first_name string, last_name string, user_account_id int, "
                         "insert_timestamp string, current_location_id int, personal_location_id int, note_backup string, deleted_reason string, deleted_timestamp string",
                         [(1, "x1", "A@x.com", None, "work@x.com", "+44 2079460000", None, "12", "see https://www.linkedin.com/in/a/?q", "Ann", "Lee", 1, AT, None, 9, "<p>hi</p>", None, None),
                          (2, None, None, None, None, None, None, None, None, "Gone", "G", 1, AT, None, None, None, "dup", None)]),
    "public_contact": ("id int, external_id string, email string, personal_email string, phone string, linkedin string, first_name string, last_name string, user_account_id int, insert_timestamp string, current_location_id int, "
                       "note_backup string, company_id int, job_title string, deleted_timestamp string",
                       [(50, "x1", "a@x.com", "z@y.com", None, None, "Ann", "Lee", 1, AT, None, None, 10, None, None), (51, None, "no_email@x.com", None, "02079461111", None, "Cy", "Zed", 9, AT, 8, None, 10, "CEO", None),
                        (52, None, None, None, None, None, "Del", "D", 1, AT, None, None, 10, None, AT)]),
    "public_contact_location": ("contact_id int, company_location_id int", [(51, 71), (51, 70)]),
    "public_company_location": ("id int, company_id int, address string, location_name string, country string, address_line1 string, city string, state string, location_types_array string",
                                [(70, 10, None, "HQ, None Specified", "UK", None, "London", None, "[HEADQUARTER]"), (71, 10, "Via 1", None, None, None, None, None, "[OTHER]")]),
    "public_common_location": ("id int, city string, country string", [(9, "Rome.", "Italy"), (8, None, "Spain")]),
    "public_company": ("id int, name string, website string, url_linkedin string, insert_timestamp string", [(10, " Acme ", "https://www.acme.com", "https://linkedin.com/company/a", AT), (11, " ", "acme.com", None, AT)]),
    "public_candidate_work_history": ("id int, candidate_id int, start_date string, end_date string, job_title string, company string, current_employer string", [(1, 1, "2020-01-01", "bad", "Dev", "d", "ACME"), (2, 1, "bad", None, "Dev", None, "Acme"), (3, 2, "2020-01-01", None, "Dev", None, "Acme")]),
    "public_activity": ("id int, category string, content string, candidate_id int, contact_id int, user_account_id int, insert_timestamp string",
                        [(1, "comment", "<p>a longer note</p>", 1, None, 1, AT), (2, "comment", "<b>short</b>", 1, None, 1, AT), (3, "comment", "on the contact", None, 51, 9, AT), (4, "task", "a longer note", 1, None, 1, AT)]),
    "public_position_description": ("id int, name string, insert_timestamp string, updated_timestamp string, public_description string, active int, company_id int, creator_account_id int, contact_id int, forecast_annual_fee double",
                                    [(100, "CTO", AT, None, "<p>x</p>", 1, 10, 1, 51, 5.0), (101, "CFO", AT, None, None, 2, 10, 9, 52, None), (102, "COO", "2020-01-01 00:00:00", None, None, 1, None, 1, None, None)]),
    "public_job_status": ("id int, name string", [(1, "OPEN"), (2, "On Hold")]),
    "public_position_candidate": ("id int, position_description_id int, candidate_id int, created_by int, associated_date string, applied_date string, sent_date string, interview1_date string, interview2_date string, interview3_date string, interview4_date string, interview5_date string, offer_date string, hire_date string, rejected_date string, "
                                  "insert_timestamp string, modified_date string",
                                  [(1, 100, 1, 1, AT, None, AT, None, AT, None, None, None, None, None, None, AT, AT), (2, 100, 1, 1, "2024-05-05", None, None, None, None, None, None, None, None, "2024-06-01", AT, AT, AT), (3, 101, 1, 9, AT, None, AT, None, None, None, None, None, None, None, AT, AT, AT)]),
    "candidate_group": ("id int, name string", [(5, "Beta"), (6, "Alpha")]),
    "public_candidate_document": ("id int, uploaded_filename string, filesize long, insert_timestamp string, saved_filename string, candidate_id int",
                                  [(1, "my cv.pdf", 12, AT, "s3/1", 1), (2, "old.doc", None, None, "s3/2", 2), (3, "x.txt", 1, AT, "s3/3", None)]),
    "candidate_functional_expertise": ("candidate_id int, functional_expertise_id int, sub_functional_expertise_id int", [(1, 5, 6), (1, 5, None), (2, 5, None)]),
}


def test_bullhorn_attributes_and_salaries(export, ctx, tmp_path):
    wanted = [AttributeSource("Job Title", "person", "bh_usercontact", "userid", "occupation"),
              AttributeSource("Towns", "company", "bh_clientcorporation", "clientcorporationid", "city || ';Elsewhere, far;0'", ";,")]
    source = dict(BULLHORN)
    schema, rows = source["bh_usercontact"]
    source["bh_usercontact"] = (schema + ", salary int, dayrate int, hourlyrate int", [(*r, 50_000, 0, 40) for r in rows])
    got = migrate("bullhorn", export(source), ctx, str(tmp_path), scoped=False, attributes=wanted, salaries=True)
    kept = set(ids(got["people"]))
    assert {(r.person_id, r.basic_salary, r.tax_method) for r in got["person_salaries"].collect()} == {
        (p, *pay) for p in kept for pay in ((50_000, "gross"), (40, "hourly_rate"))}
    assert {(r.alias, r["of"], r.multiple_values) for r in got["custom_attributes"].collect()} == {("job_title", "person", False), ("towns", "company", True)}
    options = {r.atlas_id: r.value for r in got["custom_attribute_options"].collect()}
    assert {"Elsewhere", "far"} <= set(options.values()) and "0" not in options.values()
    towns = {(r.company_id, options[r.atlas_option_id]) for r in got["company_custom_attribute_values"].collect()}
    assert {(c, "far") for c, v in towns} <= towns
    assert set(ids(got["person_custom_attribute_values"], "person_id")) <= kept


def test_recruit_crm_finds_its_shards(spark, export, ctx, tmp_path):
    users = spark.createDataFrame([("s@x.com", "Sue", 7, "u-7")], "email string, name string, id long, atlas_id string")
    for name, (schema, rows) in RECRUIT_CRM.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}.parquet")
    columns = "candidate_slug string, work_start_date string, work_end_date string, title string, description string, work_company_name string"
    for n, title in ((1, "Dev"), (60, "Ops")):
        spark.createDataFrame([("a1", "2020-01-01", None, title, None, "acme")], columns).write.parquet(f"{tmp_path}/in/work_history_{n}_data.parquet")
    got = migrate("recruit_crm", TableReader(spark, f"{tmp_path}/in"), ctx, f"{tmp_path}/out", users=users)
    assert {r.title for r in got["experiences"].collect()} == {"Dev", "Ops"}
    assert got["educations"].isEmpty()


def test_vincere(spark, export, ctx, tmp_path):
    mapping = spark.createDataFrame([("sue@corp.example.com", "Sue", 1, "u-1")], "email string, name string, id long, atlas_id string")
    got = migrate("vincere", export(VINCERE), ctx, str(tmp_path), user_mapping=mapping, closed_before="2023-01-01T00:00:00")
    assert {(r.id, r.name, r.email) for r in got["users"].collect()} == {(1, "Sue", "sue@corp.example.com"), (5, "Al Po", "al.po@corp.example.com")}
    assert {(r.id, r.company_contact_id, r.location_locality, r.overview) for r in got["people"].collect()} == {("1", 50, "Rome, Italy", "hi"), ("cont51", 51, "HQ, None Specified, Spain", None)}
    assert {(r.person_id, r.type, r.value, r.identity_type_type, r.favourite) for r in got["person_identities"].collect()} == {
        ("1", "email", "a@x.com", "personal", True), ("1", "email", "work@x.com", "personal", False), ("1", "email", "z@y.com", "corporate", False),
        ("1", "phone", "+442079460000", "personal", True), ("1", "linkedin", "linkedin.com/in/a", "personal", False), ("cont51", "phone", "02079461111", "corporate", True)}
    assert [(r.id, r.name, r.location_locality) for r in got["companies"].collect()] == [(10, "Acme", "HQ")]
    assert {(r.type, r.value) for r in got["company_identities"].collect()} == {("website", "acme.com"), ("linkedin", "linkedin.com/company/a")}
    assert {(r.id, r.person_id, r.title) for r in got["company_contacts"].collect()} == {(50, "1", "contact"), (51, "cont51", "CEO")}
    assert [(r.id, r.company_id, r.finished_at) for r in got["experiences"].collect()] == [(1, 10, None)]
    assert {(r.person_id, r.text.strip()) for r in got["person_notes"].collect()} == {("1", "a longer note"), ("cont51", "on the contact")}
    assert {(r.id, r.state, r.close_reason, r.atlas_owner_id) for r in got["projects"].collect()} == {(100, "closed", "won", "u-1"), (101, "on_hold", "cancelled", "master-0"), (102, "closed", "cancelled", "u-1")}
    assert [(r.project_id, r.company_contact_id) for r in got["project_company_contacts"].collect()] == [(100, "51")]
    assert {(r.id, r.status, r.rejection_type, r.rejected_at) for r in got["candidates"].collect()} == {(2, "Hired", "by_us", "2024-01-02T00:00:00"), (3, "Presented", "by_us", "2024-01-02T00:00:00")}
    assert {(r.value, r.position) for r in got["custom_attribute_options"].collect()} == {("Alpha", 1), ("Beta", 2)}
    assert ids(got["person_custom_attribute_values"], "person_id") == ["1", "1"]
    assert [(r.person_id, r.overview.strip()) for r in got["people_overview"].collect()] == [("1", "hi")]
    known = {r.id: r.atlas_id for r in got["people"].collect()}
    assert {(r.id, r.file_name, r.ext, r.size, r.path, r.person_id, r.atlas_person_id) for r in got["files"].collect()} == {
        (1, "my cv.pdf", "pdf", 12, "s3/1", "1", known["1"]), (2, "old.doc", "doc", None, "s3/2", "2", None)}
    assert all(r.created_at is None or r.created_at.endswith("Z") for r in got["files"].collect())


LOXO = {
    "people": ("id int, name string, `desc` string, created string, updated string, city string, state string, zip string, country string, comp_comp string, comp_notes string",
               [(1, "Ann M Lee", "o", AT, AT, "Rome!", None, None, "Italy", "50000.4", "<b>n</b>"), (2, "Cy", None, "bad", None, None, None, None, None, " ", None)]),
    "people_emails": ("root_id int, email string, type string", [(1, "A@gmail.com", "home"), (2, "a@gmail.com ", None), (2, "bad", None)]),
    "people_phones": ("root_id int, phone string, type string", [(1, "0044 20 1", " Mobile"), (2, "12", None), (2, "+1 555", "Work")]),
    "people_social": ("root_id int, value string", [(1, "https://www.linkedin.com/in/A"), (1, "http://Site.com/")]),
    "companies": ("id int, name string, `desc` string, culture string, hidden string, url string, created string, updated string", [(10, "Acme", None, "<i>c</i>", None, "https://www.Acme.com", AT, AT), (11, "Hid", None, None, "True", None, AT, AT)]),
    "companies_types": ("root_id int, row_index int, value string", [(10, 1, "Big Client"), (10, 2, "x")]),
    "companies_addresses": ("root_id int, city string, state string, zip string, country string", [(10, "Rome", "", None, "Italy")]),
    "people_types": ("root_id int, value string", [(2, "Contact"), (2, "Contact"), (1, "Candidate")]),
    "people_experience": ("row_uid string, root_id int, companyid int, company string, title string, `desc` string, from_year int, from_month int, to_year int, to_month int, current string",
                          [("e1", 1, 10, " Acme ", "Dev", "<p>d</p>", 2001, 2, 2003, 13, "false"), ("e2", 2, 10, "Acme", "CEO", None, 0, None, None, None, "true"), ("e3", 2, 10, "Acme", " ", None, None, None, None, None, "true")]),
    "people_education": ("row_uid string, root_id int, school string, degree string, `desc` string, year int, month int", [("s1", 1, " MIT ", "BSc, Maths", None, 1999, 6), ("s2", 1, " ", None, None, None, None)]),
    "jobs": ("id int, title string, company int, `desc` string, notes string, created string, updated string, status string, type string, address string, city string, state string, zip string, country string",
             [(100, "CTO", 10, "<p>x</p>", None, AT, AT, "Inactive", "Part Time", None, "Rome", None, None, "Italy"), (101, "CFO", None, None, None, AT, AT, None, None, None, None, None, None, None)]),
    "jobs_contacts": ("root_id int, value int", [(100, 2), (101, 2), (101, 1)]),
    "activities": ("id int, person int, job int, type string, notes string, created string, updated string",
                   [(1, 1, 100, "Sourced", "<b>hello</b>", AT, AT), (2, 1, 100, "Rejected", " ", AT, "2024-05-05"), (3, 2, 101, "Hired", "met", AT, AT), (4, 1, 999, "Hired", None, AT, AT)]),
    "forms": ("id int, personid int, title string", [(5, 1, "Intake")]),
    "forms_answers": ("root_id int, question string, text string", [(5, "b?", "two"), (5, "a?", " one "), (5, "c?", " ")]),
    "people_resumes": ("root_id int, path string, filename string", [(1, "r/1.pdf", "x.PDF"), (1, "", "y.pdf")]),
    "people_documents": ("root_id int, path string, filename string", [(1, "d/1", "my cv.docx")]),
    "activities_documents": ("root_id int, path string, filename string", [(1, "a/1", "note.doc"), (4, "a/2", "x.png")]),
    "companies_documents": ("root_id int, path string, filename string", [(10, "c/1", "terms"), (11, "c/2", "x")]),
}


def test_loxo(export, ctx, tmp_path):
    ctx = RunContext(ctx.client, ctx.agency_id, ctx.master_id, ctx.domain, ctx.run_ts, {"notes": ["sourced"], "meetings": ["hired"]})
    got = migrate("loxo", export(LOXO), ctx, str(tmp_path))
    assert {(r.id, r.first_name, r.last_name, r.location_locality) for r in got["people"].collect()} == {(1, "Ann", "M Lee", "Rome"), (2, "Cy", None, "")}
    assert {(r.person_id, r.type, r.value, r.identity_type_type, r.favourite) for r in got["person_identities"].collect()} == {
        (1, "email", "a@gmail.com", "personal", True), (1, "phone", "+44201", "personal", True), (2, "phone", "+1555", "corporate", False),
        (1, "linkedin", "linkedin.com/in/A", None, False), (1, "website", "site.com", None, False)}
    assert [(r.id, r.relationship, r.summary.strip(), r.location_locality) for r in got["companies"].collect()] == [(10, "client", "c", "Rome, Italy")]
    assert [(r.type, r.value) for r in got["company_identities"].collect()] == [("website", "acme.com")]
    assert [(r.person_id, r.company_id, r.title) for r in got["company_contacts"].collect()] == [(2, "10", "CEO")]
    assert {(r.id, r.started_at, r.finished_at) for r in got["experiences"].collect()} == {("e1", "2001-02-01", "2003-12-30"), ("e2", "2024-06-30", None)}
    assert [(r.degree, r.field_of_study, r.finished_at) for r in got["educations"].collect()] == [("BSc", "Maths", "1999-06-30")]
    assert {(r.id, r.state, r.close_reason, r.contract_type) for r in got["projects"].collect()} == {(100, "closed", "won", "part_time"), (101, "active", None, "full_time")}
    assert ids(got["project_company_contacts"], "project_id") == [100, 101]
    assert {(r.id, r.status, r.rejection_type, r.hired_at) for r in got["candidates"].collect()} == {(2, "Presented", "by_us", None), (3, "Hired", None, "2024-01-02T03:04:05")}
    assert {(r.id, r.text.strip()) for r in got["person_notes"].collect()} == {("1", "hello"), ("form_5", "Intake\n\n- a?: one\n- b?: two")}
    assert [(r.id, r.person_id) for r in got["meetings"].collect()] == [(3, 2)]
    assert [(r.basic_salary, r.notes) for r in got["person_salaries"].collect()] == [(50000, "n")]
    assert {(r.file_name, r.type) for r in got["file_person_mapping"].collect()} == {("r/1.pdf", "resume"), ("people/a/1", "other"), ("d/1", "resume")}
    assert ids(got["company_map_files"], "company_id") == [10]


SEVEN20 = {
    "user": ("id string, firstname string, lastname string, email string, isactive int", [("u1", "Sue", "S", "sue@corp.example.com", 1), ("u2", "X", "Y", "x@y.com", 1)]),
    "recordtype": ("id string, name string", [("r1", "Candidate"), ("r2", "Client Contact")]),
    "contact": ("id string, firstname string, lastname string, createddate string, lastmodifieddate string, mailingstreet string, mailingcity string, mailingstate string, mailingpostalcode string, mailingcountry string, "
                "experience__c string, motivations__c string, needs__c string, alternative_activity__c string, sell__c string, createdbyid string, lastmodifiedbyid string, isdeleted int, seven20__related_candidate__c string, phone string, "
                "mobilephone string, otherphone string, email string, seven20__linkedin__c string, plaunch__linkedin__c string, seven20__record_type_name__c string, recordtypeid string, title string, accountid string",
                [("c1", "Ann", "Lee", AT, AT, "1 High", "Rome", None, None, "Italy", "ten years", " ", "car", None, None, "u1", "u9", 0, None, "020 7946", None, "123456", "a@gmail.com", None, "linkedin.com/in/a", "r1", None, None, None),
                 ("c2", "Ann", "L", AT, AT, None, None, None, None, None, None, None, None, None, None, "u1", None, 0, "c1", None, "0044 7", None, "a@firm.com", None, None, "Client Contact", "r2", "CEO", "a1")]),
    "account": ("id string, name string, description string, billingstreet string, billingcity string, billingstate string, billingpostalcode string, billingcountry string, seven20__status__c string, createddate string, lastmodifieddate string, "
                "createdbyid string, numberofemployees int, phone string, website string, plaunch__linkedin__c string",
                [("a1", "Acme", "<b>x</b>", None, "Rome", None, None, None, "Live", AT, AT, "u1", 5, "12345", "https://www.Acme.com/", None), ("a2", " ", None, None, None, None, None, None, None, AT, AT, None, None, None, None, None)]),
    "task": ("id string, whoid string, createdbyid string, subject string, description string, createddate string, lastmodifieddate string",
             [("t1", "c1", "u1", "Call", "<p>a note with more than thirty characters</p>", AT, AT), ("t2", "c2", "u9", "Client Meeting", "met", AT, AT), ("t3", "c1", "u1", "Email sent", "a note with more than thirty characters", AT, AT),
              ("t4", "c1", "u1", "Call", "short", AT, AT)]),
    "seven20__education_history__c": ("id string, seven20__school_name__c string, seven20__degree_subject__c string, seven20__measure_value__c string, seven20__comments__c string, seven20__start_date__c string, seven20__end_date__c string, "
                                      "seven20__graduation_date__c string, createddate string, lastmodifieddate string, seven20__candidate__c string, isdeleted int",
                                      [("s1", "MIT", "Maths", "1st", "<i>x</i>", "2000-01-01", None, "2004-01-01", AT, AT, "c2", 0), ("s2", "", None, None, None, None, None, None, AT, AT, "c1", 0)]),
    "seven20__employment_history__c": ("id string, seven20__job_title__c string, seven20__account__c string, seven20__description__c string, seven20__start_date__c string, seven20__end_date__c string, createddate string, "
                                       "lastmodifieddate string, seven20__candidate__c string, isdeleted int", [("e1", "Dev", "ACME", None, "2001-01-01", None, AT, AT, "c1", 0), ("e2", "Dev", "Acme", None, "", None, AT, AT, "c1", 0)]),
    "seven20__job__c": ("id string, name string, seven20__client_description__c string, engagement_type__c string, seven20__job_closed__c int, seven20__status__c string, createddate string, lastmodifieddate string, "
                        "target_max_base_salary__c double, seven20__total_value__c double, seven20__city__c string, seven20__country__c string, seven20__account__c string, ownerid string, isdeleted int, seven20__hiring_manager__c string",
                        [("j1", "CTO", None, "Part Time", 0, "CV", AT, AT, 1.0, 2.0, "Rome", None, "a1", "u1", 0, "c1"), ("j2", "CFO", None, None, 1, "Interview", AT, AT, None, None, None, None, "a1", "u9", 0, None)]),
    "seven20__job_lead__c": ("id string, name string, seven20__advert_description__c string, seven20__job_lead_status__c string, createddate string, lastmodifieddate string, seven20__account__c string, ownerid string, isdeleted int, "
                             "seven20__hiring_manager__c string", [("l1", "Lead", None, "Open", "2020-01-01", AT, "a1", "u1", 0, "c9"), ("l2", "Done", None, "Converted", AT, AT, "a1", "u1", 0, None)]),
    "seven20__placement__c": ("seven20__job__c string, seven20__application__c string", [("j1", "p1"), ("j1", "p1")]),
    "seven20__application__c": ("id string, createddate string, lastmodifieddate string, seven20__stage__c string, seven20__rejected_reason__c string, seven20__date_in_stage__c string, ownerid string, seven20__candidate__c string, "
                                "seven20__job__c string, isdeleted int", [("p1", AT, AT, "Shortlist", None, AT, "u1", "c1", "j1", 0), ("p2", AT, AT, "Offer", "Rejected Offer", AT, "u9", "c1", "j2", 0), ("p3", AT, AT, "Offer", None, AT, "u1", "c1", "j1", 1)]),
}


def test_seven20(export, ctx, tmp_path):
    ctx = RunContext(ctx.client, ctx.agency_id, ctx.master_id, ctx.domain, ctx.run_ts, {"meetings": ["Client Meeting"]})
    got = migrate("seven20", export(SEVEN20), ctx, str(tmp_path))
    assert ids(got["users"]) == ["u1"]
    person = got["people"].collect()
    assert [(r.id, r.location_locality, r.overview, r.updated_by_atlas_id) for r in person] == [("c1", "1 High, Rome, Italy", "Experience: \r\nten years\r\n\r\nNeeds: \r\ncar", "master-0")]
    assert {(r.person_id, r.type, r.value, r.identity_type_type) for r in got["person_identities"].collect()} == {
        ("c1", "email", "a@gmail.com", "personal"), ("c1", "email", "a@firm.com", "corporate"), ("c1", "phone", "0207946", "personal"), ("c1", "phone", "123456", "corporate"),
        ("c1", "linkedin", "linkedin.com/in/a", None)}
    assert [(r.id, r.relationship, r.size, r.summary) for r in got["companies"].collect()] == [("a1", "client", "1-10", "x")]
    assert [(r.type, r.value) for r in got["company_identities"].collect()] == [("website", "acme.com")]
    assert [(r.id, r.person_id, r.relationship) for r in got["company_contacts"].collect()] == [("c2-a1", "c1", "client")]
    assert ids(got["person_notes"]) == ["t1"] and [(r.id, r.person_id, r.created_by_atlas_id) for r in got["meetings"].collect()] == [("t2", "c1", "master-0")]
    assert [(r.person_id, r.finished_at) for r in got["educations"].collect()] == [("c1", "2004-01-01")]
    assert [(r.id, r.company_id) for r in got["experiences"].collect()] == [("e1", "a1")]
    assert {(r.id, r.state, r.close_reason, r.contract_type) for r in got["projects"].collect()} == {
        ("j1", "closed", "won", "contract"), ("j2", "closed", "worked_lost", "full_time"), ("l1", "closed", "lead_lost", "full_time")}
    assert [(r.project_id, r.company_contact_id) for r in got["project_company_contacts"].collect()] == [("j1", "c2-a1")]
    assert {(r.id, r.status, r.rejection_type, r.rejection_reason) for r in got["candidates"].collect()} == {("p1", "Hired", None, None), ("p2", "Offer", "self", "accepted_another_offer")}


JOBADDER = {
    "user": ("userid int, email string, displayname string, lastlogindate string", [(1, " SUE@x.com", "Sue", AT), (2, None, "Al", AT)]),
    "contact": ("contactid int, firstname string, lastname string, email string, phone string, mobile string, linkedinurl string, datecreated string, dateupdated string, createdbyuserid int, updatedbyuserid int, companyaddressid int, "
                "companyid int, position string, iscandidateonly boolean, previouscontactid int, deleted boolean",
                [(1, "Ann ", "Lee", "a@gmail.com", "123", "0044 5", "https://www.linkedin.com/in/a", AT, None, 1, 9, None, 10, " ", False, None, False),
                 (2, "Bob", " ", "b@firm.com", "1-2-3", None, None, AT, AT, 2, None, 70, 10, "CEO", True, 1, False), (3, "Del", "D", "a@gmail.com", None, None, None, AT, AT, 1, 1, None, 10, None, False, None, True)]),
    "candidate": ("contactid int, addressline1 string, addressline2 string, addresssuburb string, addresspostcodesearch string, addresspostcode string, addressstate string, addresscountry string, addresscountrycode string, deleted boolean",
                  [(1, "1 High", None, " ", "N1", "N1 1", None, None, "GB", False)]),
    "candidateresumeparsing": ("contactid int, addressline1 string, addressline2 string, addresspostcode string, addressstate string, addresscountry string", [(1, "x", "Flat 2", "N9", "London", "UK"), (2, "y", None, None, None, "FR")]),
    "companyaddress": ("addressid int, companyid int, name string, line1 string, suburb string, state string, country string, postcodesearch string, url string",
                       [(70, 10, "Head Office", "5 Road", "Leeds", None, "UK", "LS1", "https://acme.com/"), (71, 10, "Branch", "6 Road", None, None, None, None, "acme.com")]),
    "company": ("companyid int, name string, statusid int, datecreated string, dateupdated string, linkedinurl string, twitterurl string, deleted boolean",
                [(10, " Acme ", 5452, AT, AT, "https://uk.linkedin.com/company/a", "https://twitter.com/a", False), (11, "Gone", 1, AT, AT, None, None, True)]),
    "note": ("noteid int, text string, datecreated string, dateupdated string, createdbyuserid int, updatedbyuserid int, type string, source string, summary string, deleted boolean",
             [(1, "<b>hi</b>&nbsp;all", AT, AT, 1, 9, "Phone call", "Note", "s", False), (2, " ", AT, AT, 1, 1, None, "Note", "s", False), (3, "firm", AT, AT, 9, 1, None, "Mail", None, False)]),
    "contactnote": ("noteid int, contactid int", [(1, 1), (1, 2), (1, 1), (2, 1)]), "candidatenote": ("noteid int, contactid int", [(1, 1), (3, 1), (1, 9)]),
    "companynote": ("noteid int, companyid int", [(3, 10), (3, 11), (3, 10)]),
    "candidateemploymenthistory": ("employmentid int, contactid int, employer string, position string, startdate string, enddate string, description string", [(1, 1, " ACME", "Dev", "2020-01-01 00:00", None, "<b>x</b>"), (2, 1, "Acme", " ", "2020-01-01", None, None)]),
    "candidateeducation": ("educationid int, contactid int, institution string, course string, enddate string", [(1, 1, "MIT", "Maths", "2001-01-01"), (2, 1, " ", None, None)]),
    "joborder": ("joborderid int, contactid int, companyid int, locationid int, owneruserid int, jobtitle string, jobdescription string, datecreated string, dateupdated string, dateclosed string, numberofjobs int, feerate double, feeamount double, "
                 "feecurrencycode string",
                 [(100, 1, 10, 5, 1, "CTO", "<p>x</p>", AT, AT, AT, 1, 20.0, 5.0, "GBP"), (101, 2, 10, None, 9, "CFO", None, AT, None, None, 1, None, None, None), (102, 1, 11, None, 1, "COO", None, AT, AT, AT, 1, None, None, None)]),
    "location": ("locationid int, name string", [(5, "Leeds")]), "placement": ("joborderid int", [(100,), (100,)]),
    "jobapplication": ("applicationid int, joborderid int, contactid int, owneruserid int, statusid int, datecreated string, dateupdated string", [(1, 100, 1, 1, 1, AT, AT), (2, 100, 1, 9, 2, AT, AT), (3, 101, 2, 1, 3, AT, None)]),
    "jobapplicationstatus": ("statusid int, name string, rejected boolean", [(1, "Offered", False), (2, "Unsuccessful", True), (3, "Been Placed", False)]),
    "candidateattachment": ("attachmentid int, contactid int, type string", [(1, 1, "Resume"), (2, 1, "Photo")]), "attachment": ("candidateattachmentid int, storagename string, filename string", [(1, "a/b/c.pdf", "cv.pdf")]),
}


def test_jobadder(spark, export, ctx, tmp_path):
    mapping = spark.createDataFrame([("sue@x.com", "Sue", 1, "u-1")], "email string, name string, id long, atlas_id string")
    got = migrate("jobadder", export(JOBADDER), ctx, str(tmp_path), user_mapping=mapping)
    assert {(r.id, r.atlas_id == "u-1") for r in got["users"].collect()} == {(1, True), (2, False)}
    assert {(r.id, r.first_name, r.last_name, r.location_locality, r.has_candidate_record, r.updated_by_atlas_id) for r in got["people"].collect()} == {
        (1, "Ann", "Lee", "1 High,Flat 2,London,N1,UK", True, "master-0"), (2, "Bob", None, "5 Road,,Leeds,LS1,UK", False, "master-0")}
    assert {(r.person_id, r.type, r.value, r.identity_type_type) for r in got["person_identities"].collect()} == {
        (1, "email", "a@gmail.com", "personal"), (2, "email", "b@firm.com", "corporate"), (1, "phone", "+445", "personal"), (1, "linkedin", "linkedin.com/in/a", "personal")}
    assert [(r.id, r.name, r.relationship, r.location_locality) for r in got["companies"].collect()] == [(10, "Acme", "client", "5 Road Leeds  UK")]
    assert {(r.type, r.value, r.is_primary) for r in got["company_identities"].collect()} == {("twitter", "x.com/a", False), ("linkedin", "linkedin.com/company/a", False), ("website", "acme.com", True)}
    assert [(r.person_id, r.title) for r in got["company_contacts"].collect()] == [(1, "Contact")]
    assert {(r.id, r.person_id, r.type, r.text) for r in got["person_notes"].collect()} == {("1_1", 1, "phone_call", "**hi** all"), ("1_2", 2, "phone_call", "**hi** all"), ("3_1", 1, "manual", "firm")}
    assert [(r.id, r.company_id, r.created_by_atlas_id) for r in got["company_notes"].collect()] == [("3_1", 10, "master-0")]
    assert [(r.id, r.company_id, r.description) for r in got["experiences"].collect()] == [(1, 10, "**x**")]
    assert ids(got["educations"]) == [1]
    assert {(r.id, r.state, r.close_reason, r.location_locality, r.fee_terms) for r in got["projects"].collect()} == {(100, "closed", "won", "Leeds", "20.0%"), (101, "active", None, None, None)}
    assert [(r.project_id, r.company_contact_id) for r in got["project_company_contacts"].collect()] == [(100, 1)]
    assert {(r.id, r.status, r.rejection_type, r.atlas_rejected_by_id) for r in got["candidates"].collect()} == {(2, "Client IV", "by_us", "master-0"), (3, "Hired", None, None)}
    assert [(r.adjusted_file_id, r.filename) for r in got["mapping_resume"].collect()] == [("c.pdf", "cv.pdf")]
    assert [(r.original_person_id, r.merge_person_id) for r in got["correction_mergepeople"].collect()] == [(1, 2)]
    assert {(r.person_id, r.location_locality) for r in got["correction_peoplelocation"].collect()} == {(1, "1 High, Flat 2,  , N1 1, GB"), (2, "y, FR")}
    assert sorted((r.id, r.person_id, r.text) for r in got["fix_contact_notes"].collect()) == [("1", 1, "hi all"), ("1", 1, "hi all"), ("1", 2, "hi all")]


MANATAL = {
    "candidate": ("id int, full_name string, created_at string, updated_at string, creator_id int, city string, country string, email string, phone_number string", [(1, "Ann M Lee (ex)", AT, AT, 7, "Rome", "Italy", "A@x.com", " "), (2, "Bob", AT, None, 9, None, "UK", None, "12")]),
    "candidate_social": ("candidate_id int, social_media_url string", [(1, "https://l.com/a/"), (2, "https://l.com/a")]),
    "contact": ("id int, full_name string, created_at string, updated_at string, location string, linkedin_url string, email string, phone_number string, organization_id int",
                [(50, "Ann Lee", AT, AT, "Paris", "https://l.com/a", "a@x.com ", "99", 10), (51, "Cy (open", AT, AT, "Oslo", None, "cy@f.com", None, 10), (52, "Di", AT, AT, None, None, None, None, 99)]),
    "organization": ("id int, name string, location string, description string, creator_id int, created_at string, updated_at string, website string", [(10, "Acme", "Rome", "d", 7, AT, AT, "https://www.Acme.com/"), (11, "Late", None, None, 9, "2025-01-01", AT, "acme.com")]),
    "candidate_note": ("id int, candidate_id int, info string, created_at string, updated_at string, creator_id int", [(1, 1, "hi", AT, AT, 7), (2, 1, " ", AT, AT, 7)]),
    "contact_note": ("id int, contact_id int, info string, created_at string, updated_at string, creator_id int", [(1, 51, "yo", AT, AT, 9)]),
    "candidate_experience": ("id int, candidate_id int, started_at string, ended_at string, position_name string, description string, employer_name string", [(1, 1, "2020-01-01", " ", "Dev", None, " ACME "), (2, 1, " ", None, "Dev", None, "Acme")]),
    "candidate_education": ("id int, candidate_id int, school_name string, degree_name string, specialization string, description string, started_at string, ended_at string", [(1, 2, "MIT", "BSc", " ", None, "", "2001-01-01"), (2, 2, " ", None, None, None, None, None)]),
    "job": ("id int, position_name string, description string, owner_id int, status string, organization_id int, created_at string, updated_at string", [(100, "CTO", None, 7, "won", 10, AT, AT), (101, "CFO", None, 9, "open", 99, AT, AT), (102, " ", None, 7, "won", 10, AT, AT)]),
    "match": ("id int, candidate_id int, job_id int, creator_id int, created_at string, updated_at string, dropped_at string, hired_at string, offer_at string, interview_at string, submitted_at string",
              [(1, 1, 100, 7, AT, AT, None, AT, None, None, None), (2, 2, 101, 9, AT, AT, AT, "", None, AT, None), (3, 9, 100, 7, AT, AT, None, None, None, None, None)]),
}


def test_manatal(spark, export, ctx, tmp_path):
    users = spark.createDataFrame([("s@x.com", "Sue", 7, "u-7")], "email string, name string, id long, atlas_id string")
    got = migrate("manatal", export(MANATAL), ctx, str(tmp_path), users=users)
    assert {(r.id, r.contact_id, r.first_name, r.last_name, r.location_locality) for r in got["people"].collect()} == {
        ("1", 50, "Ann", "M Lee ", "Rome Italy"), ("2", 50, "Bob", "", "UK"), ("cc51", 51, "Cy", "", "Oslo"), ("cc52", 52, "Di", "", "")}
    assert {(r.person_id, r.type, r.value, r.identity_type_type) for r in got["person_identities"].collect()} == {
        ("1", "email", "A@x.com", "personal"), ("2", "phone", "12", "personal"), ("1", "linkedin", "https://l.com/a/", "personal"), ("2", "linkedin", "https://l.com/a", "personal"),
        ("1", "phone", "99", "corporate"), ("cc51", "email", "cy@f.com", "corporate")}
    assert {(r.id, r.created_by_atlas_id == "u-7") for r in got["companies"].collect()} == {(10, True), (11, False)}
    assert [(r.company_id, r.value) for r in got["company_identities"].collect()] == [(10, "acme.com")]
    assert {(r.id, r.person_id) for r in got["company_contacts"].collect()} == {(50, "1"), (51, "cc51")}
    assert {(r.id, r.person_id, r.text) for r in got["person_notes"].collect()} == {("cn1", "1", "hi"), ("ctn1", "cc51", "yo")}
    assert [(r.id, r.company_id, r.finished_at) for r in got["experiences"].collect()] == [(1, 10, None)]
    assert [(r.person_id, r.started_at, r.field_of_study) for r in got["educations"].collect()] == [("2", None, None)]
    assert {(r.id, r.state, r.close_reason, r.atlas_owner_id) for r in got["projects"].collect()} == {(100, "closed", "won", "u-7"), (101, "active", None, "master-0")}
    assert {(r.id, r.status, r.rejection_type, r.rejected_at) for r in got["candidates"].collect()} == {(1, "Hired", None, None), (2, "Client IV", "by_us", "2024-01-02T00:00:00")}


_ENTITY = [(r, "u", AT, "u", AT, None, None) for r in (1, 10, 100)] + [(2, "u", AT, "u", AT, AT, "D"), (3, "u", "2020-01-01", "u", AT, None, None)]
BONDADAPT = {
    "entity_table": ("entity_id int, created_by string, createddate string, updated_by string, updateddate string, deleteddate string, status string", _ENTITY),
    "prop_person_gen": ("reference int, person_id int, first_name string, last_name string, linkedin string", [(1, 501, "Ann", "Lee", "https://linkedin.com/in/a"), (2, 502, "Del", "D", None), (3, 503, "Cy", "Z", "linkedin.com/in/a/")]),
    "prop_cand_gen": ("reference int", [(3,)]),
    "prop_address": ("reference int, street1 string, street2 string, town string, county string, post_code string, country string, bisuniqueid int",
                     [(1, " ", None, "Rome", None, None, "123", 1), (1, "1 High", None, "Rome", None, "N/A", "Italy", 2), (3, "http://x", None, "-", "Kent", None, "UK", 3)]),
    "prop_email": ("reference int, bisuniqueid int, email_add string", [(1, 11, "A@x.com"), (3, 12, "a@x.com"), (2, 13, "d@x.com")]),
    "prop_telephone": ("reference int, bisuniqueid int, tel_number string", [(1, 21, "020 7946"), (1, 22, "mailto:x"), (1, 23, "12")]),
    "prop_client_gen": ("reference int, client_id int, name string, no_empl int, web_add string", [(10, 710, "Acme", 5, "http://Acme.com/"), (2, 702, "Gone", None, None)]),
    "prop_cont_gen": ("reference int, bisuniqueid int, cur_empl int, job_title string", [(1, 31, 10, "CEO"), (3, 32, 10, " ")]),
    "journal_entries": ("id long, creation_date string, notes_edit_date string, creator_id int, j_notes string, j_document string", [(1, AT, None, 5, " ", "<b>doc</b>"), (2, AT, AT, 5, None, " ")]),
    "lk_entities_journal": ("journal_id long, entity_id int", [(1, 1), (1, 3), (1, 10), (2, 1)]),
    "prop_job_gen": ("reference int, job_title string, closed_dt string, tbref int", [(100, "CTO", None, 710), (101, "CFO", AT, None)]),
    "prop_x_short_cand": ("candidate int, job int, client int", [(1, 100, 710), (503, 100, 10), (9, 100, 10)]),
    "prop_x_int_cand": ("candidate int, job int", [(501, 100)]), "prop_x_assig_cand": ("candidate int, job int, assignment int", [(3, 100, 900)]),
    "prop_assig_gen": ("assig_id int, filled_dt string, start_dt string, end_dt string", [(900, None, "2024-03-03", AT)]),
    "phx_previousinterviewsdatacache": ("candidateid int, clientid int, enddatetime string, ivdate string, startdatetime string", [(1, 10, None, "2024-04-04", AT)]),
    "phx_upcominginterviewsdatacache": ("candidateid int, clientid int, enddatetime string, ivdate string, startdatetime string", [(1, 10, AT, None, None)]),
}


def test_bondadapt(export, ctx, tmp_path):
    got = migrate("bondadapt", export(BONDADAPT), ctx, str(tmp_path))
    assert {(r.id, r.location_locality, r.location_street_address, r.location_country) for r in got["people"].collect()} == {(1, "1 High, Rome", "1 High", "Italy"), (3, "Kent", None, "UK")}
    assert {(r.id, r.person_id, r.value) for r in got["person_identities"].collect()} == {("12_email", 3, "a@x.com"), ("21_phone", 1, "020 7946"), ("3_linkedin", 3, "linkedin.com/in/a")}
    assert [(r.id, r.name, r.size) for r in got["companies"].collect()] == [(10, "Acme", "5")]
    assert [(r.company_id, r.value) for r in got["company_identities"].collect()] == [(10, "acme.com")]
    assert [(r.person_id, r.company_id, r.title) for r in got["company_contacts"].collect()] == [(1, 10, "CEO")]
    assert {(r.id, r.text) for r in got["person_notes"].collect()} == {("1_1", "doc"), ("3_1", "doc")}
    assert [(r.id, r.company_id, r.closed_at) for r in got["projects"].collect()] == [(100, 10, "2024-06-30T00:00:00")]
    assert {(r.person_id, r.status, r.created_at) for r in got["candidates"].collect()} == {(1, "Internal IV", "2024-04-04T00:00:00"), (3, "Hired", "2024-03-03T00:00:00")}


_FLAT = "id int, name string, company string, location string, created_date string, recent_activity_date string, phone string, email string, linkedin string, type string, title string"
LOXO_CSV = {"candidate": (_FLAT, [(1, "Ann M Lee", "Acme", "Rome", AT, None, "1", "a@x.com", "https://www.linkedin.com/in/a/;", "Candidate", None)]),
            "client": (_FLAT, [(2, "Cy", " ", None, AT, AT, " ", None, "x.com", "Contact", "CEO"), (3, "Di Zed", "Beta", None, "bad", AT, "3", "", None, "Contact", None)])}


def test_loxo_csv(export, ctx, tmp_path):
    got = migrate("loxo_csv", export(LOXO_CSV), ctx, str(tmp_path))
    assert {(r.id, r.first_name, r.last_name, r.created_at) for r in got["people"].collect()} == {("1", "Ann", "M Lee", "2024-01-02T00:00:00"), ("2", "Cy", "Cy", "2024-01-02T00:00:00"), ("3", "Di", "Zed", None)}
    assert {(r.id, r.relationship) for r in got["companies"].collect()} == {(1, "target"), (3, "client")}
    assert {(r.person_id, r.type, r.value, r.identity_type_type) for r in got["person_identities"].collect()} == {
        ("1", "email", "a@x.com", "personal"), ("1", "phone", "1", "personal"), ("1", "linkedin", "linkedin.com/in/a", None), ("3", "phone", "3", "corporate")}
    assert {(r.person_id, r.atlas_company_id is None) for r in got["company_contacts"].collect()} == {("2", True), ("3", False)}


_REC = "itemid string, creatorid string, modifierid string, datecreated string, datemodified string"


def _rec(key, *rest, by="u1", at=AT):
    return (key, by, "u9", at, at, *rest)


def _links(a, b, *rows):
    return (f"{a} string, {b} string", list(rows))


INVENIAS = {
    "users": ("itemid string, username string, disabled boolean", [("u1", "SUE@corp.example.com", False), ("u2", "al@corp.example.com", True), ("u3", "x@y.com", False)]),
    "people": (_REC + ", fileas string, firstname string, familyname string, email1address string, mobilephone string, linkedin string, homestreet string, homepostalcode string, homecity string, homestate string, homecountry string, typeclientchecked boolean",
               [_rec("p1", "Sue S", "Sue", "S", "s@x.com", "1", "https://www.linkedin.com/in/s/", "1 High", "N1", "Rome", " ", None, False), _rec("p2", "Al P", "Al", "P", "S@x.com ", "a@b", None, None, None, None, None, "UK", True),
                _rec("p3", "m", "info@x.com", "B", None, None, None, None, None, None, None, None, None)]),
    "relation_usertoperson": _links("userid", "personid", ("u1", "p1"), ("u2", "p2")),
    "categorylists": ("itemid string, fileas string", [("L1", "Place"), ("L2", "Skill")]),
    "categorylistentries": ("itemid string, fileas string, categorylistid string, parentlistentryid string",
                            [("e1", "Italy", "L1", "x"), ("e2", "Europe", "L1", "x"), ("e3", "Spark", "L2", None)]),
    "relation_persontocategorylistentry": ("relationid string, person string, categorylistentryid string", [("r1", "p1", "e1"), ("r2", "p1", "e2"), ("r3", "p2", "e3"), ("r4", "p3", "e3")]),
    "companies": (_REC + ", fileas string, clientstatus string, offmarketstatus int, offmarketstartdate string, offmarketownerid string, offmarketreason string, webpage string, linkedin string, internalcomments string",
                  [_rec("c1", "Acme", "s1", 1, AT, None, "why", "https://www.acme.com/", None, "<b>n</b>"), _rec("c2", "Beta", None, None, None, None, None, "acme.com", "https://linkedin.com/company/b", " ", at="2025-01-01")]),
    "companylocationsettings": ("companylocationid string, settingname string, settingvalue string", [("l1", "CityFieldLabel", "Town"), ("l1", "CountyFieldLabel", "Kent"), ("l1", "Other", "x")]),
    "locations": ("itemid string, datecreated string, datemodified string, businessstreet string, businesspostalcode string, businesscity string, businessstate string, businesscountry string",
                  [("l1", AT, None, "5 Road", "N1", None, None, "UK"), ("l2", AT, AT, "old", None, None, None, None)]),
    "relation_companytolocation": ("companyid string, locationid string, datecreated string, datemodified string", [("c1", "l1", AT, "2024-05-05"), ("c1", "l2", AT, AT)]),
    "lookuplistentries": ("itemid string, name string", [("s1", "Current"), ("s2", "Completed"), ("s3", "*08. Submitted to Client"), ("s4", "Rejected by Candidate - Location"), ("s5", "11. Offer")]),
    "positions": (_REC + ", jobtitle string, positionstatus int, startdate string, enddate string, description string",
                  [_rec("o1", "CEO @ Other", 0, "2020-01-01", None, None), _rec("o2", "Dev", 0, "2019-01-01", None, "d", at="2020-01-01"), _rec("o3", " ", 1, "2019-01-01", "2020-01-01", None)]),
    "relation_persontoposition": _links("positionid", "personid", ("o1", "p1"), ("o2", "p1"), ("o3", "p2")), "relation_companytoposition": _links("positionid", "companyid", ("o1", "c1"), ("o2", "c1"), ("o3", "c2")),
    "personeducation": ("itemid string, startdate string, enddate string, subject string, placeofstudy string", [("d1", "2000-01-01", None, "Maths", "MIT"), ("d2", None, None, None, "MIT")]),
    "relation_persontoeducation": _links("personeducationid", "personid", ("d1", "p1"), ("d2", "p1")),
    "telephones": (_REC + ", content string, telephoneactiondate string", [_rec("t1", "<p>rang</p>", "2024-03-03")]), "emails": (_REC + ", body string", [_rec("m1", "...")]),
    "notes": (_REC + ", content string, noteactiontype string", [_rec("n1", "hi", "T1", by="u7"), _rec("n2", " ", None)]),
    "relation_persontotelephone": _links("telephoneid", "personid", ("t1", "p1"), ("t1", "p2"), ("t1", "p3")), "relation_persontoemail": _links("emailid", "personid", ("m1", "p1")),
    "relation_persontonote": _links("noteid", "personid", ("n1", "p1"), ("n2", "p1")),
    "assignments": (_REC + ", fileas string, ownerid string, status string, assignmentnumber string", [_rec("a1", "CTO", "u1", "s2", "N1"), _rec("a2", "CFO", "u9", None, "N2")]),
    "relation_companytoassignment": _links("assignmentid", "companyid", ("a1", "c1"), ("a2", "c2")),
    "relation_assignmenttoprogresstracking": _links("assignmentid", "datecreated", ("a1", AT), ("a1", "2024-02-02")),
    "relation_assignmenttoassignmentclient": _links("assignmentid", "assignmentclientid", ("a1", "x1"), ("a1", "x2")), "relation_persontoassignmentclient": _links("assignmentclientid", "personid", ("x1", "p1"), ("x2", "p2")),
    "relation_persontoteammember": _links("teammemberid", "personid", ("tm1", "p1")), "relation_assignmenttoteammember": _links("assignmentid", "teammemberid", ("a1", "tm1")),
    "relation_assignmenttoowner": _links("assignmentid", "userid", ("a1", "u1"), ("a2", "u2")),
    "relation_candidatetoassignment": ("relationid string, personid string, assignmentid string, recordstatus string, datecreated string, datemodified string",
                                       [("k1", "p1", "a1", "s3", AT, None), ("k2", "p1", "a1", "s4", AT, "2024-02-02"), ("k3", "p2", "a1", "s5", AT, None), ("k4", "p2", "a2", "s3", AT, None)]),
    "placements": ("itemid string", [("q1",)]), "relation_assignmenttoplacement": _links("placementid", "assignmentid", ("q1", "a1")), "relation_persontoplacement": _links("placementid", "personid", ("q1", "p2")),
    "permanentpackages": (_REC + ", amountfrom int, amountto int, notes string, settingid string, currency string", [_rec("y1", None, 90, "n", "g1", "z1"), _rec("y2", 1, 2, None, "g2", None)]),
    "permanentpackagessettings": ("itemid string, name string", [("g1", "Basic Salary"), ("g2", "Bonus")]), "relation_positiontopermanentpackage": _links("packageid", "positionid", ("y1", "o1"), ("y2", "o1")),
    "currencies": ("itemid string, currencycode string, currencyname string", [("z1", "GBP", "UK , pounds")]),
}


def test_invenias(spark, export, ctx, tmp_path):
    prior = spark.createDataFrame([("known-1", "sue@corp.example.com", "Sue", "active")], "id string, email string, name string, status string")
    got = migrate("invenias", export(INVENIAS), ctx, str(tmp_path), prior_users=prior, place_list="L1", call_note="T1")
    assert {(r.id, r.atlas_id == "known-1", r.name, r.status) for r in got["users"].collect()} == {("u1", True, "Sue", "active"), ("u2", False, "Al P", "disabled")}
    assert {(r.id, r.location_locality, r.location_street_address, r.created_by_atlas_id, r.updated_by_id) for r in got["people"].collect()} == {
        ("p1", "Italy, Rome", "N1 1 High", "known-1", None), ("p2", "UK", None, "known-1", None)}
    assert {(r.person_id, r.type, r.value, r.identity_type_type) for r in got["person_identities"].collect()} == {
        ("p1", "email", "s@x.com", "personal"), ("p1", "phone", "1", "personal"), ("p1", "linkedin", "linkedin.com/in/s", "personal")}
    firms = {r.id: r for r in got["companies"].collect()}
    assert (firms["c1"].relationship, firms["c1"].location_locality, firms["c1"].location_metro, firms["c1"].location_region, firms["c1"].restriction_type) == ("client", "UK, N1, 5 Road", "Town", "Kent", "hard")
    assert firms["c2"].location_locality == "" and firms["c2"].restriction_type is None
    assert {(r.company_id, r.type, r.value) for r in got["company_identities"].collect()} == {("c1", "website", "acme.com"), ("c2", "linkedin", "linkedin.com/company/b")}
    assert [(r.person_id, r.company_id, r.title) for r in got["company_contacts"].collect()] == [("p1", "c1", "CEO @ Other")]
    assert [(r.id, r.text) for r in got["company_notes"].collect()] == [("c1", "n")]
    assert {(r.id, r.person_id, r.type, r.created_by_atlas_id) for r in got["person_notes"].collect()} == {
        ("t1", "p1", "phone_call", "known-1"), ("t1", "p2", "phone_call", "known-1"), ("n1", "p1", "phone_call", "master-0")}
    assert {(r.id, r.title, r.company_name) for r in got["experiences"].collect()} == {("o1", "CEO", "Other"), ("o2", "Dev", "Acme")}
    assert ids(got["educations"]) == ["d1"]
    assert {(r.id, r.state, r.close_reason, r.closed_at) for r in got["projects"].collect()} == {("a1", "closed", "won", "2024-02-02T00:00:00"), ("a2", "on_hold", None, None)}
    assert [(r.project_id, r.company_contact_id) for r in got["project_company_contacts"].collect()] == [("a1", "p1")]
    assert {(r.project_id, r.user_id) for r in got["project_users"].collect()} == {("a1", "u1"), ("a2", "u2")}
    assert {(r.id, r.status, r.rejection_type, r.rejection_reason, r.rejected_at) for r in got["candidates"].collect()} == {
        ("k2", "Presented", "self", "location", "2024-02-02T00:00:00"), ("k3", "Hired", None, None, None), ("k4", "Presented", None, None, None)}
    assert [(r.basic_salary, r.currency, r.country) for r in got["person_salaries"].collect()] == [(90, "GBP", "UK")]
    assert {(r.value, r.position) for r in got["custom_attribute_options"].collect()} == {("Europe", 1), ("Italy", 2), ("Spark", 1)}
    assert sorted(ids(got["person_custom_attribute_values"], "person_id")) == ["p1", "p1", "p2"]


LONG = "a text that is longer than thirty characters"
FILEFINDER = {
    "user": ("iduser string, useremail string, fullname string, createdon string, modifiedon string", [("u1", "sue@corp.example.com", "Sue S", AT, AT), ("u2", "SUE@corp.example.com", "Sue T", "2025-01-01", AT), ("u3", "x@y.com", "X", AT, AT)]),
    "person": ("idperson string, firstname string, middlename string, lastname string, createdon string, modifiedon string, biography string, personcomment string, iduser string, isdeleted int, note string",
               [("p1", "Ann", None, "Lee", AT, AT, "bio", " ", "u1", 0, "<i>n</i>"), ("p2", "Cy", None, "Z", AT, AT, None, None, "u9", 0, None), ("p3", "Del", None, "D", AT, AT, None, None, None, 1, None)]),
    "person_paddress": ("idperson string, idpaddress string, idpersonaddresstype string", [("p1", "a1", "t2"), ("p1", "a2", "t1"), ("p2", "a1", "t3"), ("p1", "a3", "t1")]),
    "company_paddress": ("idcompany string, idpaddress string, idcompanyaddresstype string", [("c1", "a1", "k2"), ("c1", "a2", "k1")]),
    "paddress": ("idpaddress string, addressline1 string, addressline2 string, addressline3 string, addressline4 string, city string, countystate string, postcode string, idcountry string",
                 [("a1", "1 High", "", "Flat", None, "Rome", None, None, "x1"), ("a2", " ", None, None, None, "Pisa", None, "N1", None), ("a3", None, None, None, None, None, None, None, None)]),
    "country": ("idcountry string, value string", [("x1", "Italy")]), "personaddresstype": ("idpersonaddresstype string, value string", [("t1", "Private"), ("t2", "Second Home"), ("t3", "Business")]),
    "companyaddresstype": ("idcompanyaddresstype string, value string", [("k1", "Postal Address"), ("k2", "Invoice")]),
    "company": ("idcompany string, companyname string, companycomment string, clientrelationshipnotes string, noofemployees int, createdon string, modifiedon string, createdby string, iduser string, isdeleted int, parentid string",
                [("c1", "Acme", None, None, 5, AT, AT, "sue s", "u1", 0, "c2"), ("c2", "Beta", None, None, None, AT, AT, None, None, 0, None), ("c3", "Del", None, None, None, AT, AT, None, None, 1, "c1")]),
    "person_eaddress": ("idperson_eaddress string, idperson string, ideaddress string, idpersoncommunicationtype string, isdefault boolean, rowtimestamp string",
                        [("l1", "p1", "e1", "w1", True, AT), ("l2", "p1", "e2", "w2", False, AT), ("l3", "p2", "e3", None, None, AT), ("l4", "p2", "e4", None, None, AT), ("l5", "p2", "e1", None, None, "2025-01-01"), ("l6", "p2", "e5", None, None, AT)]),
    "company_eaddress": ("idcompany_eaddress string, idcompany string, ideaddress string, rowtimestamp string", [("m1", "c1", "e4", AT), ("m2", "c1", "e1", AT), ("m3", "c2", "e2", AT)]),
    "eaddress": ("ideaddress string, commvalue string", [("e1", "A@gmail.com"), ("e2", "+44 20 7946"), ("e3", "https://www.LinkedIn.com/in/c"), ("e4", "www.Acme.com/"), ("e5", "n/a")]),
    "personcommunicationtype": ("idpersoncommunicationtype string, value string", [("w1", "Work"), ("w2", "Home")]),
    "candidateprogress": ("idcandidateprogress string, value string", [("g1", "Shortlist Reject"), ("g2", "Placed"), ("g3", "Odd")]), "introductionprogress": ("idintroductionprogress string, value string", [("g9", "Met")]),
    "assignmentsourceprogress": ("idassignmentsourceprogress string, value string", []), "personreferenceprogress": ("idpersonreferenceprogress string, value string", []),
    "activitylog": ("idactivitylog string, subject string, description string, activitytype string, progressid string, createdby string",
                    [("i1", "Call", f"<b>{LONG}</b>", "PhoneCall", "g9", "SUE S"), ("i2", "A long enough subject", None, "Email", None, None), ("i3", "Sending letter", LONG, "Letter", None, None), ("i4", "Hi", "short", "Email", None, None)]),
    "activitylogentity": ("idactivitylogentity string, idactivitylog string, idperson string, contextentitytype string, contextentityid string, createdon string, modifiedon string",
                          [("y1", "i1", "p1", "Person", "p1", AT, None), ("y2", "i2", "p1", "Assignment", "j1", AT, None), ("y3", "i1", None, "Company", "c1", AT, None), ("y4", "i3", "p1", "Person", None, AT, None), ("y5", "i4", "p1", "Person", None, AT, None)]),
    "remuneration": ("idremuneration string, idcompany_person string, salary string, bonus string, package string, packagenote string, idcurrency string, createdby string", [("r1", "q1", "1000.5", None, "0", "n", "z1", "Sue S"), ("r2", "q1", "0", None, None, None, None, None)]),
    "company_person": ("idcompany_person string, idperson string, idcompany string, jobtitle string, companynameonly string, employmentfrom string, employmentto string, note string, isactiveemployment boolean, createdon string, modifiedon string",
                       [("q1", "p1", "c1", "CEO", "Acme", None, None, " ", True, AT, AT), ("q2", "p2", "c9", "Dev", "Else", "2001-01-01", "2002-01-01", "<i>x</i>", False, AT, AT), ("q3", "p2", "c1", "", None, None, None, None, True, AT, AT)]),
    "currency": ("idcurrency string, value string", [("z1", " usd "), ("z2", "Euros")]),
    "education": ("ideducation string, idperson string, educationsubject string, educationestablishment string, idqualification string, notes string, educationfrom string, educationto string, createdon string, modifiedon string",
                  [("d1", "p1", "Maths", "MIT", "h1", None, "2000-01-01", None, AT, AT), ("d2", "p1", None, "", None, None, None, None, AT, AT)]),
    "qualification": ("idqualification string, value string", [("h1", "BSc")]),
    "assignment": ("idassignment string, idcompany string, assignmenttitle string, assignmentbrief string, assignmentcomment string, idassignmentstatus string, idassignmenttype string, createdon string, modifiedon string, actualcompletedate string, "
                   "salaryfrom int, salaryto int, idcurrency1 string, idcurrency string, iduser string, assignmentno string, isdeleted int, baseestimatedfee int, estimatedfee int, finalfee int, feecomment string",
                   [("j1", "c1", "CTO", "<p>b</p>", None, "s1", "v1", "2024-05-05 00:00:00", AT, None, 0, 9, "z2", "z1", "u1", "N1", 0, 5, 5, 6, " x "), ("j2", "c1", "CFO", None, None, "s2", None, "2024-06-06 00:00:00", AT, None, 1, 2, None, None, "u9", "N1", 0, None, None, 0, None),
                    ("j3", "c1", "Old", None, None, "s1", None, "2020-01-01 00:00:00", AT, AT, None, None, None, None, None, "N3", 0, None, None, None, None), ("j4", "c1", "Ref", None, None, "s3", None, AT, AT, None, None, None, None, None, None, "N4", 0, None, None, None, None)]),
    "assignmentstatus": ("idassignmentstatus string, value string", [("s1", "Assign - Active"), ("s2", "Pitch complete - lost"), ("s3", "Research/Reference")]),
    "assignmenttype": ("idassignmenttype string, value string", [("v1", "Interim cover")]),
    "assignmentcontact": ("idassignment string, idperson string, createdon string, modifiedon string", [("j1", "p1", AT, AT), ("j1", "p2", AT, AT), ("j2", "p3", AT, AT)]),
    "assignmentcandidate": ("idassignmentcandidate string, idassignment string, idperson string, idcandidateprogress string, contactedon string, contactedby string, createdby string, createdon string, modifiedon string, isexcluded int",
                            [("b1", "j1", "p1", "g1", "2024-02-02", "Sue S", "Nobody", AT, AT, 0), ("b2", "j2", "p1", "g2", "2024-03-03", None, "Sue S", AT, AT, 0), ("b3", "j1", "p2", "g2", None, None, None, AT, AT, 1)]),
    "assignmentsource": ("idassignmentsource string, idassignment string, idperson string, createdby string, createdon string", [("o1", "j1", "p2", "Sue S", AT), ("o2", "j1", "p1", None, "2020-01-01")]),
    "document": ("iddocument string, newdocumentname string, originaldocumentname string, description string", [("f1", "ab12.pdf", "Doc", "My CV"), ("f2", "noext", "x", None), ("f3", "cd.txt", "terms", None)]),
    "entitydocument": ("iddocument string, entityid string", [("f1", "p1"), ("f2", "p1"), ("f3", "c1")]),
}


def test_filefinder(export, ctx, tmp_path):
    got = migrate("filefinder", export(FILEFINDER), ctx, str(tmp_path))
    assert [(r.id, r.status) for r in got["users"].collect()] == [("u1", "disabled")]
    assert {(r.id, r.location_street_address, r.location_locality, r.overview.strip()) for r in got["people"].collect()} == {("p1", "", "Pisa", "Biography: \r\nbio"), ("p2", None, None, "")}
    assert {(r.id, r.location_locality, r.size) for r in got["companies"].collect()} == {("c1", "Pisa", "1-10"), ("c2", None, None)}
    assert {(r.person_id, r.type, r.value, r.identity_type_type, r.favourite) for r in got["person_identities"].collect()} == {
        ("p1", "email", "a@gmail.com", "corporate", True), ("p1", "phone", "+44207946", "personal", True), ("p2", "linkedin", "LinkedIn.com/in/c", "corporate", False), ("p2", "website", "acme.com", "corporate", False)}
    assert {(r.company_id, r.type, r.value) for r in got["company_identities"].collect()} == {("c1", "website", "acme.com"), ("c2", "phone", "+44207946")}
    assert {(r.person_id, r.relationship, r.title) for r in got["company_contacts"].collect()} == {("p1", "client", "CEO"), ("p2", "client", "")}
    assert {(r.id, r.text) for r in got["person_notes"].collect()} == {("p1person_note", " n "), ("y2", "Subject: A long enough subject")}
    met = got["meetings"].collect()
    assert [(r.id, r.created_by_id, r.action) for r in met] == [("y1", "u1", "PhoneCall")] and met[0].notes == f"Progress: Met\r\nSubject: Call\r\nDescription:  {LONG} "
    assert ids(got["company_notes"]) == ["y3"]
    assert [(r.basic_salary, r.currency, r.created_by_id) for r in got["person_salaries"].collect()] == [(1000, "USD", "u1")]
    assert [(r.degree, r.name) for r in got["educations"].collect()] == [("BSc", "MIT")]
    assert {(r.id, r.started_at, r.description) for r in got["experiences"].collect()} == {("q1", "2000-01-01", None), ("q2", "2001-01-01", " x ")}
    assert {(r.id, r.state, r.close_reason, r.salary, r.job_number, r.contract_type) for r in got["projects"].collect()} == {
        ("j1", "active", None, "9", "N1", "contract"), ("j2", "closed", "lead_lost", "1 - 2", None, "full_time"), ("j3", "closed", "worked_lost", None, "N3", "full_time")}
    assert ids(got["project_company_contacts"], "person_id") == ["p1", "p2"]
    assert {(r.id, r.status, r.rejection_type, r.rejected_by_id, r.hired_at) for r in got["candidates"].collect()} == {
        ("b1", "Presented", "by_client", "u1", None), ("b2", "Hired", None, None, "2024-03-03T00:00:00Z"), ("o1", "Added", None, None, None)}
    assert [(r.id, r.amount, r.currency, r.notes) for r in got["project_fees"].collect()] == [("5_projected_j1", "6", "usd", "Migrated Fee: x")]
    assert [(r.company_id, r.subsidiary_id, r.created_by_atlas_id == "master-0") for r in got["company_relationships"].collect()] == [("c2", "c1", False)]
    assert [(r.person_id, r.file_name, r.type) for r in got["file_person_mapping"].collect()] == [("p1", "AB/ab12.pdf", "resume")]
    assert ids(got["company_map_files"], "company_id") == ["c1"]


def test_tables_stay_lazy_without_a_folder(export, ctx):
    got = migrate("bullhorn", export(BULLHORN), ctx, scoped=False)
    assert ids(got["people"]) == [1, 6]


def test_every_vendor_is_tested():
    assert {f"test_{v}" for v in VENDORS} <= set(globals())
