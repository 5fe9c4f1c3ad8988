"""Value domains of the population. They are data: pass your own `Domains` to replace them."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

# Regions, professions, topics, demographics and wording that a
# population has to be drawn from to be the same by seed. Order counts.

#: (regions, weight of each), in order.
REGION_GROUPS = (
    (("Dhaka",), 25.0),
    (("Chattogram",), 10.0),
    (("Rajshahi", "Khulna"), 5.0),
    (("Sylhet", "Rangpur"), 4.0),
    (("Barishal", "Mymensingh"), 3.5),
    (("Comilla",), 2.5),
    (("Gazipur", "Narayanganj"), 3.0),
    (("Cox's Bazar",), 2.0),
    (
        (
            "Bogra", "Jessore", "Dinajpur", "Tangail", "Narsingdi", "Faridpur", "Kurigram", "Bhola", "Patuakhali", "Noakhali", "Brahmanbaria",
            "Kishoreganj", "Habiganj", "Moulvibazar", "Sunamganj", "Netrokona", "Sherpur", "Jamalpur", "Chapainawabganj", "Naogaon", "Natore",
            "Pabna", "Sirajganj", "Joypurhat", "Thakurgaon", "Panchagarh", "Lalmonirhat", "Nilphamari", "Gaibandha", "Kushtia", "Meherpur",
            "Chuadanga", "Jhenaidah", "Magura", "Narail", "Satkhira", "Bagerhat", "Pirojpur", "Barguna", "Jhalokathi", "Chandpur",
            "Lakshmipur", "Feni", "Khagrachhari", "Rangamati", "Bandarban", "Manikganj", "Munshiganj", "Shariatpur", "Madaripur", "Gopalganj",
            "Chittagong Hill Tracts", "Sundarbans adjacent area",
        ),
        1.0,
    ),
    (("Char areas (Jamuna)", "Haor region (Sunamganj)", "Coastal belt (Bhola)"), 1.5),
    (("Korail Slum (Dhaka)",), 3.0),
    (("Bhashantek Bosti (Dhaka)",), 2.0),
    (("Geneva Camp (Mohammadpur)", "Railway Colony (Chattogram)"), 1.5),
    (("Sitakunda Shipbreaking Yard Area", "Char areas of Kurigram"), 2.0),
)

PROFESSIONS = (
    "RMG worker", "rickshaw puller", "day labourer", "shrimp farmer", "rice farmer", "fisherman", "tea garden worker", "brick kiln worker",
    "street food vendor", "small shopkeeper", "vegetable seller", "auto-rickshaw driver", "boat operator", "tailor", "carpenter",
    "bamboo craftsman", "pottery maker", "seasonal migrant worker", "schoolteacher", "madrasa teacher", "private tutor", "nurse",
    "pharmacy assistant", "electrician", "plumber", "mobile repair technician", "beauty parlour owner", "garments supervisor",
    "government clerk", "bank officer", "police constable", "university student", "college lecturer", "lawyer", "doctor", "engineer",
    "journalist", "NGO field worker", "tech startup employee", "freelance web developer", "Uber/Pathao driver", "e-commerce seller",
    "social media manager", "call centre agent", "Foodpanda/Pathao food delivery rider", "F-commerce (Facebook Live) clothing seller",
    "mobile banking (bKash/Nagad) agent", "freelance graphic designer (Upwork/Fiverr)", "YouTube/TikTok regional content creator",
    "Hijra (transgender) community member", "construction worker in Dubai (UAE)", "palm oil plantation worker in Malaysia",
    "convenience store clerk in Saudi Arabia", "student studying in North America/UK", "returnee migrant worker",
    "expatriate worker's wife", "retired army personnel", "widow on pension", "disabled person (on social safety net)", "domestic worker",
    "madrasa student", "unemployed youth",
)

#: Topics by category, in order.
CATEGORIES = {
    "Identity & registration": ("NID correction", "birth certificate", "death certificate", "voter ID issue", "passport renewal", "passport application delay", "marriage certificate", "citizenship certificate"),
    "Land & property": ("land registration", "land dispute resolution", "mutation of land records", "khas land allocation", "eviction notice"),
    "Social safety nets": ("education stipend", "widow allowance", "old age allowance", "disability allowance", "freedom fighter allowance", "VGD/VGF card issue", "social safety net enrollment"),
    "Agriculture & rural": ("agricultural subsidies", "fertilizer card", "crop damage compensation", "fisheries license", "livestock vaccination"),
    "Utilities & services": ("electricity billing dispute", "gas connection", "water supply complaint", "mobile court complaint", "municipality tax"),
    "Education": ("school admission", "SSC/HSC result correction", "scholarship application", "student loan", "university admission"),
    "Legal & justice": ("police report (GD)", "court case status", "bail information", "legal aid application", "dowry complaint"),
    "Health": ("hospital referral", "free medicine programme", "vaccination schedule", "disability certification"),
    "Migration & foreign": ("BMET registration", "foreign employment visa", "remittance issue", "embassy appointment"),
    "Modern digital services": (
        "Universal Pension Scheme (Prottoy/Surokkha) enrollment", "e-TIN registration and zero-return submission", "BDRIS (Birth and Death Registration) server downtime",
        "BRTA smart driving license biometric delay", "Probashi Kallyan Bank loan application", "reporting bKash fraud / cybercrime to DB police", "dual citizenship certificate for e-Passport",
    ),
}
TOPIC_CATEGORY: dict[str, str] = {topic: category for category, topics in CATEGORIES.items() for topic in topics}


@dataclass(frozen=True)
class Domains:
    regions: tuple[str, ...] = tuple(name for names, _ in REGION_GROUPS for name in names)
    region_weights: tuple[float, ...] = tuple(weight for names, weight in REGION_GROUPS for _ in names)
    professions: tuple[str, ...] = PROFESSIONS
    topics: tuple[str, ...] = tuple(TOPIC_CATEGORY)
    genders: tuple[str, ...] = ("male", "female", "other")
    gender_weights: tuple[float, ...] = (0.48, 0.48, 0.04)
    statuses: tuple[str, ...] = ("lower-income", "lower-middle-income", "middle-income", "upper-middle-income", "upper-income")
    status_weights: tuple[float, ...] = (0.30, 0.30, 0.25, 0.10, 0.05)
    educations: tuple[str, ...] = ("no formal education", "primary (class 1-5)", "secondary (class 6-10)", "SSC pass", "HSC pass", "bachelor's degree", "master's degree", "technical/vocational", "madrasa education")
    education_weights: tuple[float, ...] = (0.15, 0.20, 0.20, 0.15, 0.12, 0.08, 0.03, 0.04, 0.03)
    age_ranges: tuple[tuple[int, int], ...] = ((18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, 80))
    age_weights: tuple[float, ...] = (0.25, 0.30, 0.20, 0.12, 0.08, 0.05)
    #: Ranges of the family size and of the years of experience.
    family_sizes: tuple[int, int] = (2, 8)
    experience_years: tuple[int, int] = (1, 30)
    life_details: tuple[str, ...] = (
        "Has a family of {family_size} to support.",
        "Recently moved to {location} for work.",
        "Has been in this profession for {years_exp} years.",
        "Sole earner in the family.",
        "Supports elderly parents back in the village.",
        "First in the family to use the internet.",
        "Learned about online government services from a neighbour.",
        "Previously tried to resolve this issue at the local union parishad office.",
        "Heard about this service on community radio.",
        "A friend told them about using apps for government services.",
        "Tired of going to the government office repeatedly.",
        "Has limited access to the internet — mostly uses mobile data.",
        "Cannot take time off work to visit the government office.",
        "Has been waiting for months with no response.",
        "Was sent from one office to another without resolution.",
    )
    backstories: tuple[str, ...] = (
        "A {age}-year-old {gender} {profession} from {location}. {education_detail} Currently dealing with {pain_point}. {life_detail}",
        "{profession} based in {location}, age {age}. {education_detail} Has been struggling with {pain_point} for a while. {life_detail}",
        "Lives in {location}, works as a {profession}. {age} years old, {gender}. {education_detail} Needs help with {pain_point}. {life_detail}",
        "A {social_status} {profession} from {location}. {gender}, aged {age}. {education_detail} Frustrated about {pain_point}. {life_detail}",
    )

    def __post_init__(self):
        for names, weights in (("regions", "region_weights"), ("genders", "gender_weights"), ("statuses", "status_weights"), ("educations", "education_weights"), ("age_ranges", "age_weights")):
            if len(getattr(self, names)) != len(getattr(self, weights)):
                raise ValueError(f"{names} and {weights} differ in length")

    @classmethod
    def from_json(cls, text: str) -> Domains:
        """Domains with the given fields replaced."""
        given = json.loads(text)
        unknown = set(given) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown fields {sorted(unknown)}")
        return cls(**{k: tuple(tuple(x) if isinstance(x, list) else x for x in v) for k, v in given.items()})
