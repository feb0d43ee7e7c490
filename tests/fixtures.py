"""Small sources about invented people, one of every supported form."""

from __future__ import annotations

import json


def table(*rows: tuple[str, ...], by: str = ",") -> bytes:
    return "\r\n".join(by.join(r) for r in rows).encode()


CSV = table(("Candidate", "Mobile", "Email Address", "Employer", "Role", "City"), ("Ines Varga", "+34 612 345 678", "Ines@Varga.example", "Luma Robotics", "Controls Engineer", "Valencia"), by="|")
TWO_PEOPLE = table(("full name", "yoe", "e-mail", "email"), ("Noor Haddad", "4", "", "noor.h@example.org"), ("Noor Haddad", "9", "", "nhaddad@example.net"), by="\t")

_jobs = [
    {"employer": "Luma Robotics", "title": "Lead Controls Engineer", "start": "2020-03", "until": "present", "description": "Warehouse fleets."},
    {"employer": "Taller Norte", "title": "Firmware Developer", "start": "2014-09", "until": "2020-02"},
]
_person = {
    "display_name": "Ines Varga", "emails": ["ines@varga.example", "iv@luma.example"], "mobile": "+34612345678", "employer": "Luma Robotics", "job_title": "Lead Controls Engineer",
    "about": "Makes robots stop in time", "address": {"town": "Valencia", "country_code": "ES"}, "tags": [{"label": "Python"}, "k8s", {"skill": "postgres"}], "jobs": _jobs,
    "qualifications": [{"college": "Escola Tecnica do Mar", "level": "MSc", "subject": "Automation", "completed": 2014}], "profiles": {"linkedin": "linkedin.com/in/ines-varga/?trk=abc", "portfolio": "https://varga.example/"}, "total_experience": "11",
}
ATS = json.dumps({"version": 3, "people": [_person, "not a record"]}, indent=1).encode()
GITHUB = json.dumps({
    "user": {"login": "inesv", "name": "Ines Varga", "bio": "Makes robots stop in time", "email": "ines@varga.example", "location": "Valencia"},
    "repos": [{"language": "Rust"}, {"languages": {"C": 500, "Python": 90}}, {"language": None}, 7],
}).encode()
RESUME = "\n".join([
    "Ines Varga", "Builder of careful machines", "Hamburg, Germany", "ines@varga.example / www.linkedin.com/in/ines-varga", "",
    "Work Experience:", "Lead Controls Engineer, Luma Robotics – March 2020 – Present", "Stopping distances,", "and who is near.", "", "Firmware Developer, Taller Norte – Sep 2014 – Feb 2020", "",
    "Academics", "MSc, Automation, Escola Tecnica do Mar – 2014", "", "Technical Skills", "Python; Rust | Kubernetes", "Profile", "Likes quiet", "actuators.",
]).encode()
NOTES = "\n".join(["Talked to Ines at the fair, knows Python and a little Kafka too.", "Tel: +34 612 345 678", "Employer: Luma Robotics", "Role:", "Colour: green", "see github.com/inesv"]).encode()
BROKEN = b'{"people": [{"display_name": "Ines"'
